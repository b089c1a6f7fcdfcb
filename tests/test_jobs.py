"""Composite jobs on small invented tables."""

import random

import pytest
from pyspark.sql import functions as F

from closeworks.functions import fixed_values as V
from closeworks.operators import ordered
from closeworks.plans import (
    agency,
    billing,
    case_book,
    closing,
    entries,
    modelling,
    normalise,
    parcels,
    phases,
    settlements,
    staff,
    tax_status,
)
from closeworks.plans.payments import cost_totals, payment_fact, payment_totals
from closeworks.sources.dims import accounting_calendar, cut_calendar, hr_file_windows
from tests.helpers import day, rows

PAYMENT_FIELDS = (
    "PROCESSO_ID int, DATA_EFETIVA_DO_PAGAMENTO date, DATA_SOLICITACAO_ESCRITORIO date, SUB_TIPO string, STATUS_DO_PAGAMENTO string, VALOR double"
)
GUARANTEE_FIELDS = (
    "PROCESSO_ID int, STATUS string, STATUS_DA_GARANTIA string, TIPO_GARANTIA string, "
    "DATA_DE_LEVANTAMENTO_PARTE_CONTRARIA date, VALOR_LEVANTADO_PARTE_CONTRARIA double"
)


@pytest.fixture(scope="module")
def payments(spark):
    return spark.createDataFrame(
        [
            (1, day("2024-01-10"), None, "ACORDO - CÍVEL", "PAGO", 100.0),
            (1, day("2024-01-10"), None, "FGTS", "PAGO", 10.0),
            (1, day("2024-03-28"), None, "FGTS", "PAGO", 7.0),
            (1, day("2024-01-10"), None, "CUSTAS PROCESSUAIS - TRABALHISTA", "PAGO", 55.0),
            (2, None, day("2024-02-01"), "PENSÃO - CÍVEL", "PAGO", 20.0),
            (3, day("2024-02-01"), None, "FGTS", "CANCELADO", 9.0),
        ],
        PAYMENT_FIELDS,
    )


@pytest.fixture(scope="module")
def guarantees(spark):
    kind = "DEPÓSITO JUDICIAL"
    return spark.createDataFrame(
        [
            (1, "ATIVO", "LEVANTADA", kind, day("2024-01-10"), 5.0),
            (4, "ATIVO", "LEVANTADA", kind, day("2024-01-11"), 6.0),
            (4, "ATIVO", "LEVANTADA", kind, None, 6.0),
        ],
        GUARANTEE_FIELDS,
    )


def test_payment_fact_joins_guarantees_by_case_and_date(payments, guarantees):
    fact = payment_fact(payments, guarantees)
    totals = {(r["PROCESSO_ID"], r["DATA_EFETIVA_DO_PAGAMENTO"]): r["TOTAL_PAGAMENTOS"] for r in fact.collect()}
    assert totals == {
        (1, day("2024-01-10")): 115.0, (1, day("2024-03-28")): 7.0, (2, day("2024-02-01")): 20.0, (4, day("2024-01-11")): 6.0
    }
    by_case = {r["PROCESSO_ID"]: (r["DT_ULT_PGTO"], r["IMPOSTO"], r["TOTAL_PAGAMENTOS"]) for r in payment_totals(fact).collect()}
    assert by_case[1] == (day("2024-03-28"), 17.0, 122.0)
    assert rows(cost_totals(payments)) == [(1, 55.0)]


def _sheet(spark):
    return spark.createDataFrame(
        [
            (1, "05/01/2024", None, "", 1, None, None, "  12 "),
            (2, None, "ATIVO", "EXECUÇÃO - TRT", 0, V.DOCUMENT_ANALYSES[0], "ACORDO", "x"),
            (None, None, None, None, None, None, None, None),
            (5, None, None, None, 1, None, None, None),
        ],
        "ID_PROCESSO int, DATACADASTRO string, STATUS_M string, FASE_M string, ENCERRADOS int, DOC string, "
        "INDICACAO_PROCESSO_ESTRATEGICO string, CENTRO_DE_CUSTO_M string",
    )


def test_monthly_closing_keeps_early_payments_of_a_late_payer(spark, payments, guarantees):
    sheet = closing.clean_closing_sheet(_sheet(spark))
    assert dict(sheet.dtypes)["DATACADASTRO"] == "date" and dict(sheet.dtypes)["CENTRO_DE_CUSTO_M"] == "double"
    managerial = spark.createDataFrame(
        [(1, day("2023-01-01"), "ENCERRADO", "RECURSAL", "C", "DEF"), (2, day("2023-02-02"), "X", None, "D", "DEF")],
        "PROCESSO_ID int, DATA_REGISTRADO date, STATUS string, FASE string, CARTEIRA string, "
        "ULTIMA_POSICAO_ESTRATEGIA_JUSTIFICATIVA_ACORDO_DEFESA string",
    )
    book = closing.monthly_closing(
        sheet, managerial, payment_fact(payments, guarantees), accounting_calendar(spark), "2024-02-01"
    )
    found = {r["ID_PROCESSO"]: r for r in book.collect()}
    assert set(found) == {1, 2, 5}
    one, two = found[1], found[2]
    # The payment of March is left out, those of January count.
    assert (one["TOTAL_PAGAMENTOS"], one["DT_ULT_PGTO"], one["IMPOSTO"]) == (115.0, day("2024-01-01"), 10.0)
    assert (one["DATACADASTRO"], one["STATUS_M"], one["FASE_M"], one["DP_FASE"], one["ESTRATEGIA"]) == (
        day("2024-01-05"), "ENCERRADO", "RECURSAL", "RECURSAL", "DEF"
    )
    assert (two["DATACADASTRO"], two["FASE_M"], two["DP_FASE"], two["PROCESSO_COM_DOCUMENTO"], two["ESTRATEGIA"]) == (
        day("2023-02-02"), "EXECUÇÃO - TRT", "EXECUÇÃO", "SIM", "ACORDO"
    )
    assert two["TOTAL_PAGAMENTOS"] is None and found[5]["MES_FECH"] == day("2024-02-01")


def test_history_of_drifting_closings(spark):
    first = spark.createDataFrame([(1, 1, 5.0, "2024-01-01")], "ID_PROCESSO int, ENCERRADOS int, `Provisão Mov (M)` double, MES_FECH string")
    second = spark.createDataFrame([(2, 0, 7, "2024-02-01", "x")], "`ID PROCESSO` bigint, Encerrados int, PROVISAO_MOV_M int, MES_FECH string, novo string")
    history = closing.closing_history([first, second])
    assert history.columns == ["ID_PROCESSO", "ENCERRADOS", "PROVISAO_MOV_M", "MES_FECH", "NOVO"]
    assert rows(closing.indicators(history)) == [("2024-01-01", 1, 5.0), ("2024-02-01", 0, 7.0)]


def _case_inputs(spark):
    closings = spark.createDataFrame(
        [
            (1, day("2024-01-01"), day("2020-06-10"), day("2020-06-01"), "RECURSAL", None, 1, 0, 0, 0.0, "EMPRESA A", 10),
            (1, day("2024-03-01"), day("2020-06-10"), day("2020-06-01"), "RECURSAL TST", None, 0, 1, 0, 0.0, "EMPRESA A", 10),
            (1, day("2024-03-01"), day("2020-06-10"), day("2020-06-01"), "RECURSAL TST", None, 0, 1, 0, 0.0, "EMPRESA A", 10),
            (2, day("2024-03-01"), day("2023-03-02"), day("2023-03-02"), "CONHECIMENTO", None, None, 0, 1, float("nan"), "EMPRESA B", 99),
        ],
        "ID_PROCESSO int, MES_FECH date, DATACADASTRO date, DISTRIBUICAO date, FASE_M string, ESTRATEGIA string, NOVOS int, "
        "ENCERRADOS int, ESTOQUE int, PROVISAO_TOTAL_PASSIVO_M double, EMPRESA_M string, CENTRO_DE_CUSTO_M int",
    )
    added = {
        "REATIVADOS": F.lit(0), "INDICACAO_PROCESSO_ESTRATEGICO": F.lit("DEF"), "AREA_DO_DIREITO": F.lit("TRABALHISTA"),
        "SUB_AREA_DO_DIREITO": F.lit(None).cast("string"), "DT_ULT_PGTO": F.lit(None).cast("date"), "TOTAL_PAGAMENTOS": F.lit(1.0),
        "STATUS_M": F.lit("S"), "VLR_CAUSA": F.lit(9.0), "CARTEIRA": F.lit("E"),
    }
    managerial = spark.createDataFrame(
        [
            (1, "MINISTERIO PUBLICO DO TRABALHO", day("2010-05-05"), day("2020-05-04"), "VENDEDOR PARA", "7", None, "LOJA", "ARQUIVADO"),
            (2, "ANA", None, None, None, "8", "TERC", None, "ARQUIVADO"),
        ],
        "PROCESSO_ID int, PARTE_CONTRARIA_NOME string, PARTE_CONTRARIA_DATA_ADMISSAO date, PARTE_CONTRARIA_DATA_DISPENSA date, "
        "PARTE_CONTRARIA_CARGO_CARGO_GRUPO string, PROCESSO_ESTADO string, TERCEIRO_PRINCIPAL string, NOVO_TERCEIRO string, "
        "MOTIVO_DE_ENCERRAMENTO string",
    ).withColumn("NATUREZA_OPERACIONAL", F.lit(None).cast("string"))
    units = spark.createDataFrame([(10, "LOJA")], "CENTRO_DE_CUSTO int, BU string")
    areas = spark.createDataFrame(
        [(10, "d", "VENDAS", "DIR", "ana", "AF")],
        "CENTRO int, DESCRICAO string, NOME2 string, NOME3 string, NOME_RESPONSAVEL string, AREA_FUNCIONAL string",
    )
    clusters = spark.createDataFrame([("7", "ALTO")], "DE string, PARA string")
    third = spark.createDataFrame([("TERC", "TERC SA")], "EMPRESA_TERCEIRIZADA string, TERCEIRO_AJUSTADO string")
    return closings.withColumns(added), managerial, units, areas, clusters, third


def test_case_book(spark, payments, guarantees):
    closings, managerial, units, areas, clusters, third = _case_inputs(spark)
    totals = payment_totals(payment_fact(payments, guarantees))
    book = case_book.case_book(
        closings, managerial, totals, units, areas, clusters, third, override=("EMPRESA B", "B", "BB")
    )
    found = {(r["ID_PROCESSO"], str(r["MES_FECH"])): r for r in book.collect()}
    assert book.count() == 3
    new, closed, stock = found[(1, "2024-01-01")], found[(1, "2024-03-01")], found[(2, "2024-03-01")]
    assert (closed["TOTAL_PAGAMENTOS"], closed["ACORDO"], closed["GARANTIA"], closed["DT_ULT_PGTO"]) == (
        122.0, 100.0, 5.0, day("2024-03-28")
    )
    assert (new["TOTAL_PAGAMENTOS"], new["ACORDO"], new["MOTIVO_ENC_AGRP"], new["MOTIVO_ENCERRAMENTO"]) == (1.0, 0.0, None, "")
    assert (closed["MOTIVO_ENC_AGRP"], closed["FASE"], closed["DP_FASE"], closed["DP_NATUREZA"]) == ("ACORDO", "N/A", "DEMAIS", "DEFESA")
    assert (closed["PERIODO_RECL_GRUPO"], closed["SAFRA_RECLAMACAO"], closed["FX_TEMPO_EMPRESA"]) == (
        "06-2015 a 05-2020", "2015", "Acima de 10 anos"
    )
    assert (closed["MESES_AGING_ENCERR"], closed["CLUSTER_AGING"], closed["FX_ANO_AGING_ENCERR"]) == (45, "3 - 4 ANOS", "3 - 6 anos")
    assert (closed["CARGO_TRATADO"], closed["CLUSTER_VALOR"], closed["BU"], closed["ET"]) == ("VENDEDOR", "ALTO", "LOJA", "Sem info")
    assert (stock["BU"], stock["AREA_FUNCIONAL"], stock["ET"], stock["TRIM_ESTOQ"]) == ("B", "BB", "TERC SA", "SIM")
    assert (stock["NOVOS"], stock["PROVISAO_TOTAL_PASSIVO_M"], stock["SAFRA_RECLAMACAO"]) == (0, 0.0, "Sem info")
    # Eleven whole months: the day of registration is later in the month.
    assert (stock["AGING_ESTOQ_MESES"], stock["FX_MES_AGING_ESTOQ"], stock["CLUSTER_AGING"]) == (11, "7 - 12 meses", "ATÉ 1 ANO")

    own = case_book.enriched_cases(
        case_book.tidy_closings(closings.withColumn("AREA_FUNCIONAL", F.lit("PRÓPRIA"))), managerial, units, areas
    )
    assert {(r["AREA_FUNCIONAL"], r["AREA_FUNCIONAL_CENTRO"]) for r in own.collect()} == {("PRÓPRIA", "AF"), ("PRÓPRIA", None)}

    extract = case_book.tax_extract(book, totals, "2024-03-01").collect()
    assert [(r["ID_PROCESSO"], r["TOTAL_PAGAMENTOS"], r["MOTIVO_ENC_AGRP"]) for r in extract] == [(1, 122.0, "ACORDO")]
    model = modelling.modelling_base(
        book, spark.createDataFrame([(1, day("2020-05-30")), (1, day("2020-05-20"))], "PROCESSO_ID int, DISTRIBUICAO date"),
        cut_calendar(spark), "2024-04-01",
    ).collect()
    assert len(model) == 1
    assert (model[0]["DIA_CORTE"], model[0]["DISTRIBUICAO"], model[0]["DISTRIBUICAO_AJUSTADA"], model[0]["DT_ULT_PGTO"]) == (
        day("2024-03-25"), day("2020-05-20"), day("2020-05-01"), day("2024-03-01")
    )
    assert rows(modelling.closed_per_month(book, "2024-04-01")) == [(day("2024-03-01"), 1)]


def test_entries_of_all_eras(spark):
    calendar = accounting_calendar(spark)
    active = spark.createDataFrame(
        [(1, day("2019-11-25"), "", "AB1234CD", "SP"), (2, day("2018-01-01"), "77", "X", "RJ")],
        "PROCESSO_ID int, DATA_REGISTRADO date, FILIAL string, CENTRO_DE_CUSTO_AREA_DEMANDANTE_NOME string, PROCESSO_ESTADO string",
    )
    book = spark.createDataFrame(
        [(3, 1, day("2021-07-01"), day("2021-06-01")), (4, 1, day("2021-08-01"), day("2021-06-01")), (5, 0, day("2021-07-01"), day("2021-06-01"))],
        "ID_PROCESSO int, NOVOS int, MES_FECH date, DATACADASTRO date",
    )
    everything = entries.entries_base(
        entries.managerial_entries(active, calendar, "ATIVOS <2019"), entries.book_entries(book, "2020", "2021-07-01")
    )
    chosen = everything.select("ID_PROCESSO", "SOURCE", "MES_FECH", "NOVO_X_LEGADO", "FILIAL", "ESTADO")
    assert rows(chosen) == [
        (1, "ATIVOS <2019", day("2019-12-01"), "LEGADO", "1234", "SP"), (3, "2020", day("2021-07-01"), "NOVO", None, None)
    ]
    assert rows(entries.entries_per_month(everything, "2020-01-01")) == [(day("2021-07-01"), 1)]


def test_terminations_against_new_cases(spark):
    fields = "CPF bigint, MATRICULA int, DESLIGAMENTO string, ADMISSAO string, CodCCustoContabil int, DescricaoN1 string, FUNCAO string, SOURCE string"
    january = spark.createDataFrame(
        [
            (11, 1, "2024-01-15", "2023-12-01", 10, "E", "Jovem Aprendiz", "HC 20240207.xlsx"),
            (11, 1, "2024-01-15", "2023-12-01", 10, "E", "Jovem Aprendiz", "HC 20240207.xlsx"),
            (12, 2, "2024-02-15", "2020-12-01", 10, "E", "VENDEDOR", "HC 20240207.xlsx"),
            (None, 3, "2024-01-15", "2023-12-01", 10, "E", "X", "HC 20240207.xlsx"),
        ],
        fields,
    )
    february = spark.createDataFrame([(12, 2, "2024-02-15", "2020-12-01", 10, "E", "VENDEDOR", "HC 20240311.xlsx")], fields)
    reported = staff.reported_terminations([january, february.drop("FUNCAO")], hr_file_windows(spark))
    assert sorted(r["CPF"] for r in reported.collect()) == [11, 12]
    book = spark.createDataFrame(
        [
            (100, 1, day("2024-02-01"), day("2024-01-15"), "RECURSAL", "000.000.000-11"),
            (101, 1, day("2024-01-01"), day("2024-01-15"), "X", "11"),
            (102, 0, day("2024-01-01"), day("2024-01-15"), "X", "12"),
            (103, 1, day("2024-01-01"), day("2024-01-15"), "X", "sem"),
        ],
        "ID_PROCESSO int, NOVOS int, MES_FECH date, DATA_DISPENSA date, FASE string, PARTE_CONTRARIA_CPF string",
    )
    managerial = spark.createDataFrame([(100, "1 2", "PRÓPRIO"), (101, "3", "TERCEIRO"), (102, "03", "OUTRA"), (103, "3", "OUTRA")], "PROCESSO_ID int, MATRICULA string, NATUREZA_OPERACIONAL string")
    cases = staff.new_cases_by_person(book, managerial)
    assert [(r["CPF"], r["ID_PROCESSO"], r["MATRICULA"], r["DP_FASE"]) for r in cases.collect()] == [(11, 100, "12", "RECURSAL_TRT")]
    units = spark.createDataFrame([(10, "LOJA")], "CENTRO_DE_CUSTO int, BU string")
    areas = spark.createDataFrame(
        [(10, "d", "VENDAS", "DIR", "ana", "AF")],
        "CENTRO int, DESCRICAO string, NOME2 string, NOME3 string, NOME_RESPONSAVEL string, AREA_FUNCIONAL string",
    )
    found = {r["CPF"]: r for r in staff.terminations_monthly(reported, cases, units, areas).collect()}
    assert (found[11]["NOVOS"], found[11]["FLAG_DT_DISPENSA"], found[11]["TIPO_CARGO"], found[11]["TIPO_CONTRATO"]) == (
        1, 1, "Aprendiz", "Contrato Experiência"
    )
    assert (found[12]["NOVOS"], found[12]["FLAG_DT_DISPENSA"], found[12]["FX_TMP_EMPRESA"], found[12]["DP_VP_DIRETORIA"]) == (
        0, None, "3 - 5 anos", "VENDAS"
    )
    written = []
    assert staff.append_history(written.append, reported, "fechamento") and len(written) == 1
    assert not staff.append_history(written.append, reported, "teste") and len(written) == 1
    with pytest.raises(ValueError):
        staff.append_history(written.append, reported, "outro")
    nature = staff.with_nature(spark.createDataFrame([(3, "x"), (9, "y")], "MATRICULA int, v string"), managerial)
    assert rows(nature) == [(3, "x", "OUTRA"), (3, "x", "TERCEIRO"), (9, "y", None)]


def test_termination_study_counts_an_employee_once(spark):
    fields = "MATRICULA string, CPF bigint, STATUS_COLABORADOR string, DATA_ADMISSAO date, DATA_DESLIGAMENTO date"
    history = spark.createDataFrame(
        [("1", 11, "Desligado", day("2010-01-01"), day("2020-01-10")), ("1", 11, "DESLIGADO", day("2021-01-01"), day("2022-01-10"))], fields
    )
    previews = spark.createDataFrame(
        [("1", 11, "DESLIGADO-R", day("2010-01-01"), day("2020-01-10")), ("2", 12, "ATIVO", day("2010-01-01"), None)], fields
    ).withColumn("EMAIL", F.lit("x"))
    people = staff.all_terminations(history, previews)
    assert people.count() == 3 and "EMAIL" not in people.columns
    book = spark.createDataFrame(
        [(100, day("2020-02-01"), 1, "000.000.000-11"), (101, day("2020-05-01"), 0, None)], "ID_PROCESSO int, MES_FECH date, NOVOS int, PARTE_CONTRARIA_CPF string"
    )
    managerial = spark.createDataFrame([(101, "11", None)], "PROCESSO_ID int, PARTE_CONTRARIA_CPF string, MATRICULA string")
    every = staff.termination_study(people, book, managerial)
    assert every.count() == 5 and every.agg(F.sum("QTDE")).first()[0] == 2
    last = staff.termination_study(people, book, managerial, last_only=True)
    assert sorted((r["MATRICULA"], r["CPF"], r["ID_PROCESSO"], r["QTDE"]) for r in last.fillna(0).collect()) == [
        ("00000001", "000.000.000-11", 100, 1), ("00000001", "000.000.000-11", 101, 0), ("00000002", "000.000.000-12", 0, 1)
    ]


def test_phase_roll(spark):
    snapshots = spark.createDataFrame(
        [(1, "2024-01-01", "RECURSAL"), (1, "2024-02-01", "RECURSAL TST"), (1, "2024-03-01", None), (2, "2024-01-01", "X"), (3, "2024-01-01", " X ")],
        "ID_PROCESSO int, m string, FASE string",
    ).withColumn("MES_FECH", F.to_date("m"))
    book = spark.createDataFrame(
        [(1, "2024-01-01", 0), (1, "2024-03-01", 1), (2, "2024-01-01", 1), (3, "2024-01-01", None)], "ID_PROCESSO int, m string, ENCERRADOS int"
    ).withColumn("MES_FECH", F.to_date("m"))
    rolled = phases.roll_forward(phases.phase_history(snapshots, book, "2024-01-01"))
    found = [(r["ID_PROCESSO"], r["MUDOU_FASE"], r["DP_FASE_MES"]) for r in rolled.orderBy("ID_PROCESSO", "MES_FECH").collect()]
    assert found == [(1, 0, None), (1, 2, "RECURSAL_TRT - RECURSAL_TST"), (1, 3, "RECURSAL_TST - ENCERRADO"), (3, 0, None)]
    provisions = spark.createDataFrame([(1, day("2024-02-01"), 5.0)], "ID_PROCESSO int, MES_FECH date, PROVISAO_MOV_M double")
    matrix = phases.transition_matrix(rolled, provisions)
    assert matrix.agg(F.sum("QTDE"), F.sum("PROVISAO_MOV_M")).first() == (4, 5.0)
    wide = phases.transition_pivot(rolled, ["202401", "202402"])
    assert wide.columns == [
        "ID_PROCESSO", "MUDOU_FASE_202401", "DP_FASE_202401", "MUDOU_FASE_202402", "DP_FASE_202402", "MUDOU_FASE_OUTROS", "DP_FASE_OUTROS"
    ]
    assert rows(wide)[0][3:5] == (2, "RECURSAL_TRT - RECURSAL_TST")


def test_installment_control(spark):
    payments = spark.createDataFrame(
        [
            (1, "C", day("2022-01-10"), None, None, 300.0, "PARCELAMENTO 916 - 30%"),
            (1, "C", day("2022-02-10"), None, None, 120.0, "1ª PARCELA"),
            (1, "C", day("2022-02-10"), None, None, 580.0, "2ª PARCELA"),
            (1, "C", day("2021-02-10"), None, None, 580.0, "2ª PARCELA"),
            (2, "A", day("2022-03-05"), 50.0, "PARCELA DE ACORDO", None, None),
            (2, "A", day("2022-03-05"), 50.0, "PARCELA DE ACORDO", None, None),
            (2, "A", day("2022-04-05"), 60.0, "ÚLTIMA PARCELA DE ACORDO", None, None),
            (3, "A", day("2022-04-05"), 60.0, "PARCELA DE ACORDO", None, None),
        ],
        "PROCESSO_ID int, SUB_TIPO string, DATA_EFETIVA_DO_PAGAMENTO date, ACORDO double, PARCELAMENTO_ACORDO string, CONDENACAO double, "
        "PARCELAMENTO_CONDENACAO string",
    )
    closings = spark.createDataFrame(
        [
            (1, None, "1ª PARCELA", day("2022-01-01"), "EXECUÇÃO", 1000.0, 2000.0),
            (2, "PARCELA DE ACORDO", None, day("2022-03-01"), "RECURSAL", 100.0, 200.0),
            (2, "PARCELA DE ACORDO", None, day("2022-04-01"), "OUTRA", 1.0, 2.0),
            (4, None, "PAGAMENTO SEM PARCELAMENTO", day("2022-04-01"), "OUTRA", 1.0, 2.0),
        ],
        "ID_PROCESSO int, PARCELAMENTO_ACORDO string, PARCELAMENTO_CONDENACAO string, MES_FECH date, FASE_M string, PROVISAO_M_1 double, "
        "PROVISAO_TOTAL_M_1 double",
    )
    agreed = spark.createDataFrame(
        [(2, 2, 110.0, 1.0, 2.0, 3.0)],
        "ID int, QUANTIDADE_DE_PARCELAS int, VALOR_DO_ACORDO_FECHADO double, ALCADA_1 double, ALCADA_2 double, ALCADA_3 double",
    )
    control = parcels.installment_control(payments, closings, agreed)
    found = [
        (r["PROCESSO_ID"], r["PARCELA"], r["QUITADO"], str(r["DT_VENCIMENTO_PARCELA"]), r["FASE"], round(r["PROVISAO_M_1_PARCELA"], 2))
        for r in control.orderBy("PROCESSO_ID", "PARCELA", "VALOR_PARCELA_PAGA").collect()
    ]
    assert found == [
        (1, 1, "SIM", "2022-01-10", "EXECUÇÃO", 300.0),
        (1, 2, "SIM", "2022-03-12", "EXECUÇÃO", 116.67),
        (1, 2, "SIM", "2022-03-12", "EXECUÇÃO", 116.67),
        (2, 1, None, "2022-03-05", "RECURSAL", 50.0),
        (2, 2, None, "2022-05-05", "RECURSAL", 50.0),
    ]


def test_agency_book(spark, payments, guarantees):
    closings = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 1)], "ID_PROCESSO int, ENCERRADOS int")
    paid = spark.createDataFrame(
        [
            (1, day("2024-01-10"), None, "MULTA - REGULATÓRIO", "PAGO", 10.0),
            (1, day("2024-02-10"), None, "ACORDO - MEDIAÇÃO", "CANCELADO", 10.0),
            (3, day("2024-02-10"), None, "ACORDO - MEDIAÇÃO", "PAGO", 10.0),
        ],
        PAYMENT_FIELDS,
    )
    managerial = spark.createDataFrame([(1, "G")], "PROCESSO_ID int, GRUPO string")
    book = agency.agency_book(closings, paid, guarantees, managerial, accounting_calendar(spark))
    assert rows(book.select("ID_PROCESSO", "TOTAL_PAGAMENTOS", "MOTIVO_ENC_AGRP", "MES_PAGAMENTO", "GRUPO")) == [
        (1, 15.0, "CONDENACAO", day("2024-01-01"), "G"), (2, 0.0, "SEM ONUS", None, None),
        (3, 10.0, None, day("2024-02-01"), None), (4, 6.0, "CONDENACAO", None, None),
    ]


def test_calculator_billing(spark):
    fields = "PROCESSO_ID int, OBSERVACAO string, ANALISE string, ESCRITORIO string, STATUS_DA_TAREFA string, DATA_DE_CONFIRMACAO string"
    first = spark.createDataFrame(
        [
            (1, V.TASK_PREFIX + "INICIAL", "FATURAR", "E1", V.LATE_STATUS, "05/01/2024"),
            (2, V.TASK_PREFIX + "INICIAL", "NÃO FATURAR", "E1", V.LATE_STATUS, "05/01/2024"),
            (3, "FINAL", "FATURAR", "E2", V.LATE_STATUS, "05/01/2024"),
        ],
        fields,
    )
    second = spark.createDataFrame([(4, "FINAL", "FATURAR", "E1", V.ON_TIME_STATUS, "05/01/2024"), (5, "FINAL", "FATURAR", "E1", V.ON_TIME_STATUS, "06/01/2024")], fields)
    prices = spark.createDataFrame([("INICIAL", 100.0, None), ("FINAL", 200.0, 300.0)], "TIPO_DE_TAREFA string, E1 double, E2 double")
    penalties = spark.createDataFrame([("INICIAL", 0.1, 0.2), ("FINAL", 0.5, 50.0)], "TIPO_DE_TAREFA string, E1 double, E2 double")
    history = spark.createDataFrame([(4, "FINAL", day("2024-01-05")), (5, "FINAL", day("2024-01-05"))], "PROCESSO_ID int, NATUREZA_DO_SERVICO string, DATA_DE_CONFIRMACAO date")
    bills = billing.calculator_billing([first, second], prices, penalties, history)
    assert rows(bills.select("PROCESSO_ID", "VALOR_TAREFA", "VALOR_FINAL", "DESCONTO_SLA", "STATUS_PAGAMENTO")) == [
        (1, 100.0, 90.0, 0.1, "Não pago no mês"), (2, 0.0, 0.0, 0.1, "Não pago no mês"), (3, 300.0, 250.0, 50.0, "Não pago no mês"),
        (4, 200.0, 0.0, 0.0, "Pago no mês"), (5, 200.0, 200.0, 0.0, "Não pago no mês"),
    ]


def test_expert_billing(spark):
    tasks = spark.createDataFrame(
        [
            ("1", "10", "E1", "TIPO A", "ANEXAR QUESITO", "Faturar"),
            ("2_x000D_", None, "E1", "TIPO A", "VISITA", "não faturar"),
            ("3", "12", "E2", "TIPO B", "CÁLCULO", "FATURAR"),
            ("4", "13", "E3", "TIPO B", "ANEXAR QUESITO", "FATURAR"),
            ("5", "14", "E3", None, "ANEXAR QUESITO", None),
        ],
        "PROCESSO_ID string, TAREFA_ID string, ESCRITORIO string, TIPO_DE_PERICIA string, TIPO_DA_TAREFA string, ANALISE string",
    )
    reference = spark.createDataFrame([("TIPO A", "MÉDICA"), ("TIPO B", "CONTÁBIL")], "DE string, PARA string")
    bands = spark.createDataFrame(
        [("E1", "MÉDICA", "X", 100.0, 90.0)], "ESCRITORIO string, TIPO_DE_PERICIA string, TIPO_ACAO string, `ATÉ 10 PERÍCIAS` double, `ENTRE 11 E 30 PERÍCIAS` double"
    )
    by_task = spark.createDataFrame([("E2", "CÁLCULO", 40.0)], "ESCRITORIO string, TIPO string, VALOR double")
    by_report = spark.createDataFrame([("E3", "CONTÁBIL", 30.0), ("E2", "CONTÁBIL", 99.0)], "ESCRITORIO string, TIPO_DE_PERICIA string, VALOR double")
    discounts = spark.createDataFrame([("ANEXAR QUESITO", 0.5)], "QUESITO string, VALOR double")
    history = spark.createDataFrame(
        [(3, "CONTÁBIL", "FATURADO", "E2", "CÁLCULO", 40.0), (3, "CONTÁBIL", "FATURADO", "E2", "CÁLCULO", 2.0)],
        "PROCESSO_ID int, TIPO_DE_PERICIA string, FATURAR string, FORNECEDOR string, TIPO_DA_TAREFA string, PRECO_FINAL double",
    )
    bills = billing.expert_billing(tasks, reference, bands, by_task, by_report, discounts, history, ["E3"])
    chosen = bills.select("PROCESSO_ID", "TAREFA_ID", "VALOR", "DESCONTO", "VALOR_FINAL", "FATURAR", "QTD_OCORRENCIAS_NO_HISTORICO", "VALOR_PAGAMENTOS_ANTERIORES")
    assert rows(chosen) == [
        (1, 10, 100.0, 0.5, 50.0, "FATURADO", 0, 0.0), (2, 0, 0.0, None, 0.0, "NÃO FATURADO", 0, 0.0),
        (3, 12, 40.0, None, 0.0, "NÃO FATURAR", 2, 42.0), (4, 13, 30.0, None, 30.0, "FATURADO", 0, 0.0),
    ]


def test_tax_status_roll(spark):
    previous = spark.createDataFrame([(1, "ATIVO", 10.0), (2, "ATIVO", 20.0), (3, "REATIVADO", 30.0)], "ID_PROCESSO int, STATUS string, INSS double")
    sheet = spark.createDataFrame(
        [(1, "ATIVO", None, 0.0, 1), (1, "ENCERRADO", None, 5.0, 2), (2, "ATIVO", None, 0.0, 1), (None, "X", None, 0.0, 1)],
        "ID_PROCESSO int, STATUS_M string, MOTIVO_MOVIMENTACAO string, PROVISAO_TOTAL_M double, LINHA int",
    )
    assert tax_status.repeated_cases(sheet.filter("ID_PROCESSO is not null")).count() == 2
    rolled = tax_status.roll_status(previous, sheet, "2024-02-01", [F.desc("LINHA")])
    assert rows(rolled.select("ID_PROCESSO", "STATUS")) == [(1, "ENCERRADO"), (2, "ATIVO" + V.WRITE_OFF_SUFFIX), (3, "REATIVADO")]
    assert rows(tax_status.open_amount(rolled, "INSS")) == [(day("2024-02-01"), 30.0)]
    history = rolled.unionByName(previous.withColumn("MES_FECH", F.lit("2024-01-01").cast("date")))
    wide = tax_status.status_columns(history, ["202401", "202402"])
    assert wide.columns == ["ID_PROCESSO", "STATUS_202401", "STATUS_202402"]
    assert rows(wide)[0] == (1, "ATIVO", "ENCERRADO")


@pytest.mark.parametrize("hot", [1_000_000, 6])
def test_tax_status_of_many_months_as_rolled_month_by_month(spark, monkeypatch, hot):
    monkeypatch.setattr(ordered, "HOT", hot)
    r = random.Random(hot)
    months = [day(f"2024-{m:02d}-01") for m in range(2, 10)]
    first = [(i, r.choice(["ATIVO", "REATIVADO", "ENCERRADO", None]), float(i), day("2024-01-01")) for i in range(40)]
    fields = "ID_PROCESSO int, STATUS string, INSS double, MES_FECH date"
    closing_rows = [
        (r.choice([i, None]) if k else i, m, r.choice([None, "ATIVO", "ATIVO", "ENCERRADO"]), r.choice([None, None, "x", V.SETTLEMENT_MOTIVE]), r.choice([None, 0.0, 5.0]), k)
        for i in range(45) for m in [day("2023-12-01"), day("2024-01-01"), *months] for k in range(2) if r.random() < 0.3
    ]
    sheet = spark.createDataFrame(
        closing_rows, "ID_PROCESSO int, MES_FECH date, STATUS_M string, MOTIVO_MOVIMENTACAO string, PROVISAO_TOTAL_M double, LINHA int"
    )
    got = tax_status.roll_months(spark.createDataFrame(first, fields), sheet, months, ["LINHA"])
    assert got.columns == ["ID_PROCESSO", "STATUS", "INSS", "MES_FECH"]
    state, want = [f[:3] for f in first], []
    for month in months:
        own = sheet.where(F.col("MES_FECH") == month).drop("MES_FECH")
        previous = spark.createDataFrame(state, "ID_PROCESSO int, STATUS string, INSS double")
        state = rows(tax_status.roll_status(previous, own, month, ["LINHA"]).select("ID_PROCESSO", "STATUS", "INSS"))
        want += [(*row, month) for row in state]
    assert sorted(rows(got), key=str) == sorted(want, key=str)
    corrected = [(7, "ATIVO", 1.0, day("2024-05-01"))]
    again = tax_status.roll_months(spark.createDataFrame(first[7:8] + corrected, fields), sheet.limit(0), ["2023-12-01", "2024-04-01", "2024-06-01"], ["LINHA"])
    assert sorted(rows(again), key=str) == [(7, "ATIVO", 1.0, day("2024-06-01")), (7, first[7][1], 1.0, day("2024-04-01"))]


def test_weekly_settlements(spark):
    sheet = spark.createDataFrame(
        [(1, "R$ 60.000,50", "A VISTA", "2", "05/01/2024", "S1"), (2, "-", None, "x", None, "S2")],
        "`ID.` int, `VALOR DO ACORDO FECHADO` string, `A VISTA/PARCELADO` string, `QUANTIDADE DE PARCELAS` string, `DATA ACORDO` string, `SEMANA (BOLETIM)` string",
    )
    found = settlements.weekly_settlements(sheet)
    assert found.columns == [
        "ID_PROCESSO", "VALOR_DO_ACORDO_FECHADO", "A_VISTA_PARCELADO", "QUANTIDADE_DE_PARCELAS", "DATA_ACORDO", "SEMANA_NUMERO",
        "SEMANA_BOLETIM", "TOTAL_APTO_MES", "MES_DATA_ACORDO", "QTD_ACORDO", "FAIXA",
    ]
    assert rows(found.select("ID_PROCESSO", "VALOR_DO_ACORDO_FECHADO", "QUANTIDADE_DE_PARCELAS", "MES_DATA_ACORDO", "QTD_ACORDO", "FAIXA")) == [
        (1, 60000.5, 2, day("2024-01-01"), 1, "R$ 50 - 100 mil"), (2, 0.0, None, None, 0, None)
    ]


def test_normalised_tables(spark):
    sheet = spark.createDataFrame(
        [("7_x000D_", "nan", "R$ 1,50", "05/01/2024", "06/01/2024", 3)], "`Processo - ID` string, `Situação` string, `Valor (R$)` string, `Data A` string, `Data-A` string, n int"
    )
    found = normalise.normalised_table([sheet], ids=["PROCESSO_ID", "OUTRO"], money=["VALOR_R"])
    assert found.columns == ["PROCESSO_ID", "SITUACAO", "VALOR_R", "DATA_A", "DATA_A_1", "N"]
    assert rows(found) == [(7, None, 1.5, day("2024-01-05"), day("2024-01-06"), 3)]
    text = normalise.normalised_table([sheet], dates=["DATA_A"], as_text=True, blanks="text")
    assert rows(text.select("N", "DATA_A", "DATA_A_1")) == [("3", day("2024-01-05"), "06/01/2024")]
    control = normalise.payments_control(spark.createDataFrame([("NaN", 1)], "`Área X` string, vazio int"), {"AREA_X": "AREA"}, ["vazio"])
    assert control.columns == ["AREA"] and rows(control) == [(None,)]
    driver = normalise.cost_driver(spark.createDataFrame([(None, 1, 2)], "`a b` string, c int, d int").toDF("a b", "c.", "c"))
    assert driver.columns == ["A_B", "C"] and rows(driver) == [("", 1)]
    base = normalise.managerial_base(
        spark.createDataFrame([("05/01/2024", "0.5", "06/01/2024")], "`DATA DE REGISTRO` string, `PERCENTUAL SÓCIO` string, `DISTRIBUIÇÃO` string"),
        more_dates=["DISTRIBUIÇÃO", "AUSENTE"],
    )
    assert base.columns == ["DATA_DE_REGISTRO", "PERCENTUAL_SOCIO", "DISTRIBUICAO"]
    assert rows(base) == [(day("2024-01-05"), 0.5, day("2024-01-06"))]


def test_study_counts_a_person_with_two_registrations_once(spark):
    left = day("2024-01-05")
    people = spark.createDataFrame(
        [("1", "111.444.777-35", left), ("2", "11144477735", left), ("3", None, left), ("4", "000.000.000-00", left), (None, None, left), (None, "0", left)],
        "MATRICULA string, CPF string, DATA_DESLIGAMENTO date",
    )
    book = spark.createDataFrame(
        [(10, None, day("2024-02-01"), 1), (11, "111.444.777-35", day("2024-03-01"), 1), (12, None, left, 1), (13, "000.000.000-00", left, 1)],
        "ID_PROCESSO int, PARTE_CONTRARIA_CPF string, MES_FECH date, NOVOS int",
    )
    managerial = spark.createDataFrame([(10, None, "00000002"), (12, None, "3"), (13, None, None)], "PROCESSO_ID int, PARTE_CONTRARIA_CPF string, MATRICULA string")
    got = staff.termination_study_by_person(people, book, managerial)
    found = sorted(rows(got.select("MATRICULA", "ID_PROCESSO", "NOVOS", "QTDE")), key=str)
    both = [r for r in found if r[0] in ("00000001", "00000002")]
    assert sorted(r[:2] for r in both) == [("00000001", 10), ("00000001", 11), ("00000002", 10), ("00000002", 11)] and sum(r[3] for r in both) == 1
    assert ("00000003", 12, 1, 1) in found and ("00000004", None, 0, 1) in found
    nobody = [r for r in found if r[0] is None]
    assert [r[1:3] for r in nobody] == [(None, 0)] * 2 and sum(r[3] for r in nobody) == 1
    assert got.select("PESSOA").distinct().count() == 4

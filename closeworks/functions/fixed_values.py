"""Business word lists, bin edges and calendar dates.

The results depend on these exact spellings and numbers, so they are written out
as they occur in the data.
"""

# ---- payments -----------------------------------------------------------------

# Payment subtype per measure column.
PAYMENT_CLASSES = {
    "ACORDO": [
        "ACORDO - CÍVEL",
        "ACORDO - CÍVEL ESTRATÉGICO",
        "ACORDO - CÍVEL MASSA",
        "ACORDO - TRABALHISTA",
        "PAGAMENTO DE ACORDO - TRABALHISTA (FK)",
        "RNO - ACORDO - TRABALHISTA",
        "ACORDO - CÍVEL MASSA - CARTÕES",
        "ACORDO - CÍVEL MASSA - FORNECEDOR",
        "ACORDO - CÍVEL MASSA - MKTPLACE",
        "ACORDO - CÍVEL MASSA - SEGURO",
        "ACORDO - IMOBILIÁRIO",
        "ACORDO - MEDIAÇÃO",
        "ACORDO - REGULATÓRIO - PROCON COM AUDIÊNCIA",
        "ACORDO/ PROGRAMAS DE PARCELAMENTO - REGULATÓRIO",
        "MULTA ACORDO - TRABALHISTA",
        "RNO - MULTA ACORDO - TRABALHISTA",
    ],
    "CONDENACAO": [
        "CONDENAÇÃO - CÍVEL",
        "CONDENAÇÃO - CÍVEL ESTRATÉGICO",
        "CONDENAÇÃO - CÍVEL MASSA",
        "CONDENAÇÃO - CÍVEL MASSA (INCONTROVERSO)",
        "CONDENAÇÃO - REGULATÓRIO",
        "CONDENAÇÃO - TRABALHISTA",
        "CONDENAÇÃO - TRABALHISTA (INCONTROVERSO)",
        "CONDENAÇÃO - CÍVEL MASSA (INCONTROVERSO) - CARTÕES",
        "CONDENAÇÃO - CÍVEL MASSA (INCONTROVERSO) - FORNECEDOR",
        "CONDENAÇÃO - CÍVEL MASSA (INCONTROVERSO) - MKTPLACE",
        "CONDENAÇÃO - CÍVEL MASSA (INCONTROVERSO) - SEGURO",
        "CONDENAÇÃO - CÍVEL MASSA - CARTÕES",
        "CONDENAÇÃO - CÍVEL MASSA - FORNECEDOR",
        "CONDENAÇÃO - CÍVEL MASSA - MKTPLACE",
        "CONDENAÇÃO - CÍVEL MASSA - SEGURO",
        "CONDENAÇÃO - IMOBILIÁRIO",
        "CONDENAÇÃO - IMOBILIÁRIO (INCONTROVERSO)",
        "MULTA - REGULATÓRIO",
        "MULTA PROCESSUAL - CÍVEL",
        "MULTA PROCESSUAL - TRABALHISTA",
        "MULTA PROCESSUAL - CÍVEL ESTRATÉGICO",
        "MULTA PROCESSUAL - IMOBILIÁRIO",
        "RNO - CONDENAÇÃO - TRABALHISTA",
        "RNO - CONDENAÇÃO - TRABALHISTA (INCONTROVERSO)",
        "RNO - MULTA PROCESSUAL - TRABALHISTA",
        "MULTA POR EMBRAGOS PROTELATÓRIOS - TRABALHISTA",
    ],
    "CUSTAS": [
        "HONORÁRIOS CONCILIADOR - CIVEL MASSA",
        "HONORÁRIOS PERICIAIS - CÍVEL ESTRATÉGICO",
        "HONORÁRIOS PERICIAIS - CÍVEL MASSA",
        "HONORÁRIOS PERICIAIS - IMOBILIÁRIO",
        "HONORÁRIOS PERICIAIS - TRABALHISTA",
        "HONORÁRIOS CONCILIADOR - CIVEL MASSA - CARTÕES",
        "HONORÁRIOS CONCILIADOR - CIVEL MASSA - FORNECEDOR",
        "HONORÁRIOS CONCILIADOR - CIVEL MASSA - MKTPLACE",
        "HONORÁRIOS CONCILIADOR - CIVEL MASSA - SEGURO",
        "HONORÁRIOS PERICIAIS - CÍVEL MASSA - CARTÕES",
        "HONORÁRIOS PERICIAIS - CÍVEL MASSA - FORNECEDOR",
        "HONORÁRIOS PERICIAIS - CÍVEL MASSA - MKTPLACE",
        "HONORÁRIOS PERICIAIS - CÍVEL MASSA - SEGURO",
        "HONORÁRIOS SUCUMBENCIAIS - REGULATÓRIO",
        "PAGAMENTO DE HONORÁRIOS PERICIAIS - TRABALHISTA (FK)",
        "RNO - HONORÁRIOS PERICIAIS -TRABALHISTA",
        "CUSTAS FK - TRABALHISTA",
        "CUSTAS PERITOS - CÍVEL",
        "CUSTAS PERITOS - IMOBILIÁRIO",
        "CUSTAS PROCESSUAIS - CÍVEL",
        "CUSTAS PROCESSUAIS - CÍVEL ESTRATÉGICO",
        "CUSTAS PROCESSUAIS - CÍVEL MASSA",
        "CUSTAS PROCESSUAIS - IMOBILIÁRIO",
        "CUSTAS PROCESSUAIS - REGULATÓRIO",
        "CUSTAS PROCESSUAIS - TRABALHISTA",
        "CUSTAS PROCESSUAIS - CÍVEL MASSA - CARTÕES",
        "CUSTAS PROCESSUAIS - CÍVEL MASSA - FORNECEDOR",
        "CUSTAS PROCESSUAIS - CÍVEL MASSA - MKTPLACE",
        "CUSTAS PROCESSUAIS - CÍVEL MASSA - SEGURO",
        "PAGAMENTO DE CUSTAS - TRIBUTÁRIO",
        "PERITOS - REGULATÓRIO",
        "RNO - CUSTAS PROCESSUAIS - TRABALHISTA",
    ],
    "IMPOSTO": [
        "RNO - INSS/IR - DARF E-SOCIAL",
        "INSS - TRABALHISTA",
        "IR - TRABALHISTA",
        "PAGAMENTO DE INSS - INDENIZAÇÃO TRABALHISTA (FK)",
        "PAGAMENTO DE IR - INDENIZAÇÃO TRABALHISTA (FK)",
        "RNO - INSS - TRABALHISTA",
        "RNO - IR - TRABALHISTA ",
        "RNO - FGTS",
        "FGTS",
        "INSS/IR - DARF E-SOCIAL",
    ],
    "PENHORA": [
        "LIBERAÇÃO DE PENHORA - MASSA",
        "LIBERAÇÃO DE PENHORA MASSA",
        "LIBERAÇÃO DE PENHORA - REGULATÓRIO",
    ],
    "PENSAO": [
        "PENSÃO - CÍVEL",
        "PENSÃO - CÍVEL ESTRATÉGICO",
        "PENSÃO - CÍVEL MASSA",
    ],
    "OUTROS_PAGAMENTOS": [
        "ACERTO CONTÁBIL: BLOQUEIO COM TRANSFERÊNCIA BANCÁRIA - DEP. JUDICIAL  (PAG)",
        "ACERTO CONTÁBIL: BLOQUEIO COM TRANSFERÊNCIA BANCÁRIA - PAGAMENTO",
        "ACERTO CONTÁBIL: PAGAMENTO DE ACORDO COM BAIXA DE DEP. JUDICIAL",
        "LIMINAR (CÍV. MASSA)",
        "PAGAMENTO",
        "PAGAMENTO AUTUAÇÃO MINISTÉRIO DO TRABALHO - TRABALHISTA",
        "PAGAMENTO DE EXECUÇÃO - TRABALHISTA",
        "PAGAMENTOS - ALL - VV",
        "PAGAMENTOS FK",
    ],
}

# Subtypes listed under a measure column that are nevertheless not
# let through by the filter on valid subtypes.
UNLISTED_SUBTYPES = ["INSS/IR - DARF E-SOCIAL"]

# Payment subtypes of the consumer-agency book.
AGENCY_PAYMENT_CLASSES = {
    "ACORDO": [
        "ACORDO - MEDIAÇÃO",
        "ACORDO - REGULATÓRIO - PROCON COM AUDIÊNCIA",
        "ACORDO/ PROGRAMAS DE PARCELAMENTO - REGULATÓRIO",
    ],
    "CONDENACAO": ["CONDENAÇÃO - REGULATÓRIO", "MULTA - REGULATÓRIO"],
    "CUSTAS": ["CUSTAS PROCESSUAIS - REGULATÓRIO"],
    "PENHORA": ["LIBERAÇÃO DE PENHORA - REGULATÓRIO"],
}

# Payment statuses that void a payment.
VOID_PAYMENT_STATUSES = ["REMOVIDO", "CANCELADO", "REJEITADO", "EM CORREÇÃO", "PENDENTE"]
AGENCY_VOID_STATUSES = ["CANCELADO", "REMOVIDO", "REJEITADO"]
RETURNED_PAYMENT = "PAGAMENTO DEVOLVIDO"

# ---- guarantees ---------------------------------------------------------------

# Guarantee types of the labour book.
GUARANTEE_TYPES = [
    "ACERTO CONTÁBIL: BLOQUEIO COM TRANSFERÊNCIA BANCÁRIA - DEP. JUDICIAL",
    "DEPÓSITO",
    "DEPÓSITO GARANTIA DE JUIZO - CÍVEL",
    "DEPÓSITO JUDICIAL",
    "DEPÓSITO JUDICIAL - CÍVEL",
    "DEPÓSITO JUDICIAL - CÍVEL ESTRATÉGICO",
    "DEPÓSITO JUDICIAL - CÍVEL MASSA",
    "DEPÓSITO JUDICIAL - REGULATÓRIO",
    "DEPÓSITO JUDICAL REGULATÓRIO",
    "DEPÓSITO JUDICIAL - TRABALHISTA",
    "DEPOSITO JUDICIAL TRABALHISTA",
    "DEPÓSITO JUDICIAL TRABALHISTA - BLOQUEIO",
    "DEPÓSITO JUDICIAL TRABALHISTA BLOQUEIO - TRABALHISTA",
    "DEPÓSITO JUDICIAL TRIBUTÁRIO",
    "DEPÓSITO RECURSAL - AIRO - TRABALHISTA",
    "DEPÓSITO RECURSAL - AIRR",
    "DEPÓSITO RECURSAL - AIRR - TRABALHISTA",
    "DEPÓSITO RECURSAL - CÍVEL MASSA",
    "DEPÓSITO RECURSAL - EMBARGOS TST",
    "DEPÓSITO RECURSAL - RO - TRABALHISTA",
    "DEPÓSITO RECURSAL - RR - TRABALHISTA",
    "DEPÓSITO RECURSAL AIRR",
    "DEPÓSITO RECURSAL RO",
    "PENHORA - GARANTIA",
    "PENHORA - REGULATÓRIO",
]

# Guarantee types of the consumer-agency book.
AGENCY_GUARANTEE_TYPES = [
    "ACERTO CONTÁBIL: BLOQUEIO COM TRANSFERÊNCIA BANCÁRIA - DEP. JUDICIAL",
    "BEM MÓVEL - CÍVEL",
    "BEM MÓVEL - CÍVEL MASSA",
    "BEM MÓVEL - REGULATÓRIO",
    "CARTA DE FIANÇA - CÍVEL",
    "CARTA DE FIANÇA - CÍVEL MASSA",
    "CARTA DE FIANÇA - REGULATÓRIO",
    "DEPÓSITO",
    "DEPÓSITO GARANTIA DE JUIZO - CÍVEL",
    "DEPÓSITO JUDICIAL",
    "DEPÓSITO JUDICIAL - CÍVEL",
    "DEPÓSITO JUDICIAL - CÍVEL ESTRATÉGICO",
    "DEPÓSITO JUDICIAL - CÍVEL MASSA",
    "DEPÓSITO JUDICIAL - REGULATÓRIO",
    "DEPÓSITO JUDICAL REGULATÓRIO",
    "DEPÓSITO JUDICIAL TRIBUTÁRIO",
    "DEPÓSITO RECURSAL - AIRR",
    "DESPÓSITO RECURSAL - CÍVEL MASSA",
    "DEPÓSITO RECURSAL - EMBARGOS TST",
    "DEPÓSITO RECURSAL AIRR",
    "DEPÓSITO RECURSAL RO",
    "IMÓVEL - CÍVEL MASSA",
    "IMÓVEL - REGULATÓRIO",
    "INATIVO",
    "LEVANTAMENTO DE CRÉDITO",
    "LEVANTAMENTO DE CRÉDITO - CÍVEL MASSA",
    "PENHORA - GARANTIA",
    "PENHORA - REGULATÓRIO",
]

VOID_GUARANTEE_STATUSES = ["CANCELADO"]
REMOVED_STATUS = "REMOVIDO"

# ---- phases -------------------------------------------------------------------

# Phase spellings of the financial closing (three groups).
CLOSING_PHASES = {
    "DEMAIS": ["", "N/A", "INATIVO", "ENCERRAMENTO", "ADMINISTRATIVO"],
    "EXECUÇÃO": [
        "EXECUÇÃO",
        "EXECUÇÃO - TRT",
        "EXECUÇÃO - TST",
        "EXECUÇÃO DEFINITIVA",
        "EXECUÇÃO DEFINITIVA (TRT)",
        "EXECUÇÃO DEFINITIVA (TST)",
        "EXECUÇÃO DEFINITIVA PROSSEGUIMENTO",
        "EXECUÇÃO PROVISORIA (TRT)",
        "EXECUÇÃO PROVISORIA (TST)",
        "EXECUÇÃO PROVISÓRIA",
        "EXECUÇÃO PROVISÓRIA PROSSEGUIMENTO",
    ],
    "RECURSAL": [
        "RECURSAL",
        "RECURSAL TRT",
        "RECURSAL TST",
        "RECURSAL - INATIVO",
        "RECURSAL TRT - INATIVO",
    ],
}

# Phase spellings of the case book (appeals split by court).
BOOK_PHASES = {
    "DEMAIS": ["", "N/A", "INATIVO", "ENCERRAMENTO", "ADMINISTRATIVO", "DEMAIS"],
    "EXECUÇÃO": [
        "EXECUCAO",
        "EXECUÇÃO",
        "EXECUÇÃO - INATIVO",
        "EXECUÇÃO - TRT",
        "EXECUÇÃO - TST",
        "EXECUÇÃO DEFIN",
        "EXECUÇÃO DEFINITIVA",
        "EXECUÇÃO DEFINITIVA (TRT)",
        "EXECUÇÃO DEFINITIVA (TST)",
        "EXECUÇÃO DEFINITIVA PROSSEGUIMENTO",
        "EXECUÇÃO PROVI",
        "EXECUÇÃO PROVISÓRIA",
        "EXECUÇÃO PROVISORIA (TRT)",
        "EXECUÇÃO PROVISORIA (TST)",
        "EXECUÇÃO PROVISÓRIA PROSSEGUIMENTO",
    ],
    "RECURSAL_TRT": ["RECURSAL", "RECURSAL - INATIVO", "RECURSAL TRT", "RECURSAL TRT - INATIVO"],
    "RECURSAL_TST": ["RECURSAL TST - INATIVO", "RECURSAL TST"],
}
CLOSED_PHASE = "ENCERRADO"

# Document analyses that count as "document available".
DOCUMENT_ANALYSES = [
    "ACORDO 1 - PÓS ANÁLISE DE SUBSÍDIOS - DOCUMENTAÇÃO COMPLETA, MAS É DESFAVORÁVEL",
    "ACORDO 1 - PÓS ANÁLISE DE SUBSÍDIOS - DOCUMENTAÇÃO ENTREGUE FORA DO PRAZO DA TAREFA DE SUBSÍDIOS",
    "ACORDO 1 - PÓS ANÁLISE DE SUBSÍDIOS - DOCUMENTAÇÃO NÃO ATENDE (DOCUMENTOS INSUFICIENTES PARA DEFESA)",
    "ACORDO 2 - PÓS AUDIÊNCIA - AUDIÊNCIA ADIADA/CONCILIAÇÃO FRUSTRADA - DOCUMENTAÇÃO NÃO ATENDE OU É DESFAVORÁVEL",
    "ACORDO 2 - PÓS AUDIÊNCIA - AUDIÊNCIA FAVORÁVEL - MAS DOCUMENTAÇÃO NÃO FOI SUFICIENTE NA APRESENTAÇÃO DA DEFESA",
    "ACORDO 2 - PÓS AUDIÊNCIA - CONCILIAÇÃO REALIZADA - (DOCUMENTAÇÃO NÃO FOI SUFICIENTE NA APRESENTAÇÃO DA DEFESA)",
    "ACORDO 3 - PÓS ACÓRDÃO - NULIDADE DA SENTENÇA/RETORNO AO CONHECIMENTO - DOCUMENTAÇÃO NÃO ATENDE",
]

# Truncated strategy spellings.
STRATEGIES = {
    "ACORDO": ["ACO", "ACOR", "ACORD", "ACORDO", " ACORDO"],
    "DEFESA": ["DEF", "DEFE", "DEFES", "DEFESA", " DEFESA"],
}

# Ministry names whose cases have no phase.
MINISTRY_PARTIES = [
    "MINISTERIO DO TRABALHO E EMPREGO",
    "MINISTERIO DO TRABALHO E EMPREGO - 11/07/2019 - 11/07/2019",
    "MINISTÉRIO PÚBLICO DO TRABALHO",
    "MINISTÉRIO PÚBLICO DO TRABALHO - 01/01/2014 - 31/12/2014",
    "MINISTÉRIO PÚBLICO DO TRABALHO - 01/12/2013 - 09/03/2015",
    "MINISTÉRIO PÚBLICO DO TRABALHO - 22/06/2006 - 31/05/2007",
    "MINISTERIO PUBLICO DO TRABALHO",
]
MINISTRY_WORDS = ["MINISTERIO", "MINISTÉRIO"]

# ---- job titles ---------------------------------------------------------------

# Job titles reported by name; all others are OUTROS.
BOOK_TITLES = [
    "AJUDANTE",
    "AJUDANTE EXTERNO",
    "ANALISTA",
    "AUXILIAR",
    "CAIXA",
    "GERENTE",
    "MONTADOR",
    "MOTORISTA",
    "OPERADOR",
    "VENDEDOR",
]
MODEL_TITLES = [
    "AJUDANTE",
    "AJUDANTE EXTERNO",
    "ANALISTA",
    "AUXILIAR",
    "ASSESSOR DE ATENDIMENTO",
    "GERENTE",
    "MONTADOR",
    "MOTORISTA",
    "OPERADOR",
    "VENDEDOR",
]

# Job-title synonyms.
TITLE_SYNONYMS = {
    "VENDEDOR II": ["ASSESSOR DE VENDAS II", "VENDEDOR INTERNO II"],
    "ASSESSOR PROD TECNOLOGIA": ["ASSESSOR TECNICO", "ASSESSOR PROD TECNOLOGIA"],
    "ASSESSOR DE ATENDIMENTO": [
        "ATENDENTE LOJA",
        "ASSISTENTE DE LOJAS MOBILE",
        "AUX ESTOQUE",
        "CAIXA",
        "ASSESSOR DE ATENDIMENTO",
    ],
    "CONS ADM LOJA": [
        "COORD ADM LOJA",
        "COORD ADMINISTRATIVO LOJA",
        "COORDENADOR ADM LOJA I",
        "COORDENADOR ADM LOJA II",
    ],
    "VENDEDOR": [
        "VENDEDOR MOBILE",
        "VENDEDOR MOVEIS PLANEJADOS",
        "VENDEDOR INTERNO",
        "CONS VENDAS",
        "ASSESSOR DE VENDAS",
    ],
    "BALCÃO 130": ["AUX ESTOQUE 130", "CAIXA 130", "ASSISTENTE DE LOJAS MOBILE130"],
}

# ---- case nature --------------------------------------------------------------

SOLVENT_THIRD_PARTY = "TERCEIRO SOLVENTE"
INSOLVENT_THIRD_PARTY = "TERCEIRO INSOLVENTE"
COLLECTIVE_SUB_AREA = "CONTENCIOSO COLETIVO"
COLLECTIVE_AREA = "TRABALHISTA COLETIVO"

# ---- bins: half-open (start, end] -> label ------------------------------------

# Bin edges and labels.
STOCK_MONTH_BINS = [
    (-99999, 6, "até 6 meses"),
    (6, 12, "7 - 12 meses"),
    (12, 18, "13 - 18 meses"),
    (18, 24, "19 - 24 meses"),
    (24, 9999999, "+24 meses"),
]
CASE_DAY_BINS = [
    (-99999, 360, "até 1 ano"),
    (360, 1080, "1 - 3 anos"),
    (1080, 2160, "3 - 6 anos"),
    (2160, 3240, "6 - 9 anos"),
    (3240, 99999999, "+9 anos"),
]
MODEL_DAY_BINS = [
    (-99999, 360, "até 1 ano"),
    (360, 720, "1 - 2 anos"),
    (720, 1080, "2 - 3 anos"),
    (1080, 1440, "3 - 4 anos"),
    (1440, 1800, "4 - 5 anos"),
    (1800, 2160, "5 - 6 anos"),
    (2160, 2520, "6 - 7 anos"),
    (2520, 9999999, "+7 anos"),
]
TENURE_DAY_BINS = [
    (-99999, 360, "até 1 ano"),
    (360, 720, "1 - 2 anos"),
    (720, 1080, "2 - 3 anos"),
    (1080, 1440, "3 - 4 anos"),
    (1440, 1800, "4 - 5 anos"),
    (1800, 2160, "5 - 6 anos"),
    (2160, 3600, "6 - 10 anos"),
    (3600, 9999999, "Acima de 10 anos"),
]
STAFF_TENURE_BINS = [
    (-99999, 360, "até 1 ano"),
    (360, 1080, "1 - 3 anos"),
    (1080, 2160, "3 - 5 anos"),
    (2160, 9999999, "+5 anos"),
]
CLUSTER_MONTH_BINS = [
    (None, 12, "ATÉ 1 ANO"),
    (12, 24, "1 - 2 ANOS"),
    (24, 36, "2 - 3 ANOS"),
    (36, 48, "3 - 4 ANOS"),
    (48, 60, "4 - 5 ANOS"),
    (60, 72, "5 - 6 ANOS"),
    (72, 84, "6 - 7 ANOS"),
    (84, None, "+7 ANOS"),
]
SETTLEMENT_BRACKETS = [
    (1, 50000, "Até R$ 50 mil"),
    (50000, 100000, "R$ 50 - 100 mil"),
    (100000, 200000, "R$ 100 - 200 mil"),
    (200000, 500000, "R$ 200 - 500 mil"),
    (500000, None, "Acima R$ 500 mil"),
]
VOLUME_BANDS = [
    (0, 10, "ATÉ 10 PERÍCIAS"),
    (10, 30, "ENTRE 11 E 30 PERÍCIAS"),
    (30, 50, "ENTRE 31 E 50 PERÍCIAS"),
    (50, None, "ACIMA DE 50 PERÍCIAS"),
]

# ---- installments -------------------------------------------------------------

COURT_PLAN = "PARCELAMENTO 916 - 30%"
COURT_PLAN_DOWN_PAYMENT = 0.3
COURT_PLAN_LATER_PARTS = 6
NO_COURT_PLAN = ["PAGAMENTO SEM PARCELAMENTO", "SALDO - PARCELAMENTO INDEFERIDO"]
NO_PLAN = ["PAGAMENTO SEM PARCELAMENTO", ""]
SETTLEMENT_PART = "PARCELA DE ACORDO"
LAST_SETTLEMENT_PART = "ÚLTIMA PARCELA DE"

# ---- tax status and billing ---------------------------------------------------

OPEN_STATUSES = ["ATIVO", "REATIVADO"]
SETTLEMENT_MOTIVE = "4. Acordo/Vazio para Defesa"
WRITE_OFF_SUFFIX = " - BAIXA POR REVERSÃO DE PROVISÃO"
TASK_PREFIX = "CONTADOR: EFETUAR O CÁLCULO - "
LATE_STATUS = "Confirmados em Atraso"
ON_TIME_STATUS = "Confirmados"
DISCOUNTED_TASKS = ["ANEXAR QUESITO", "ANEXAR IMPUGNAÇÃO/MANIFESTAÇÃO"]
PAID_BEFORE = "NÃO FATURAR - PAGO EM MÊS ANTERIOR"
NO_INFO = "Sem info"

# ---- calendars ----------------------------------------------------------------

# Month, first and last day of each accounting month. Two days are set right: 2019-12 ends in
# 2019 (written with 2020), and 2025-01 starts in 2024 (written with 2025).
ACCOUNTING_MONTHS = [
    ("2018-11-01", "1900-01-01", "2018-11-20"),
    ("2018-12-01", "2018-11-21", "2018-12-17"),
    ("2019-01-01", "2018-12-18", "2019-01-21"),
    ("2019-02-01", "2019-01-22", "2019-02-18"),
    ("2019-03-01", "2019-02-19", "2019-03-19"),
    ("2019-04-01", "2019-03-20", "2019-04-21"),
    ("2019-05-01", "2019-04-22", "2019-05-21"),
    ("2019-06-01", "2019-05-22", "2019-06-17"),
    ("2019-07-01", "2019-06-18", "2019-07-21"),
    ("2019-08-01", "2019-07-22", "2019-08-20"),
    ("2019-09-01", "2019-08-21", "2019-09-22"),
    ("2019-10-01", "2019-09-23", "2019-10-23"),
    ("2019-11-01", "2019-10-24", "2019-11-21"),
    ("2019-12-01", "2019-11-22", "2019-12-19"),
    ("2020-01-01", "2019-12-20", "2020-01-26"),
    ("2020-02-01", "2020-01-27", "2020-02-28"),
    ("2020-03-01", "2020-02-29", "2020-03-24"),
    ("2020-04-01", "2020-03-25", "2020-04-20"),
    ("2020-05-01", "2020-04-21", "2020-05-19"),
    ("2020-06-01", "2020-05-20", "2020-06-23"),
    ("2020-07-01", "2020-06-24", "2020-07-29"),
    ("2020-08-01", "2020-07-30", "2020-08-21"),
    ("2020-09-01", "2020-08-22", "2020-09-22"),
    ("2020-10-01", "2020-09-23", "2020-10-22"),
    ("2020-11-01", "2020-10-23", "2020-11-24"),
    ("2020-12-01", "2020-11-25", "2020-12-18"),
    ("2021-01-01", "2020-12-19", "2021-01-23"),
    ("2021-02-01", "2021-01-24", "2021-02-22"),
    ("2021-03-01", "2021-02-23", "2021-03-21"),
    ("2021-04-01", "2021-03-22", "2021-04-21"),
    ("2021-05-01", "2021-04-22", "2021-05-23"),
    ("2021-06-01", "2021-05-24", "2021-06-21"),
    ("2021-07-01", "2021-06-22", "2021-07-22"),
    ("2021-08-01", "2021-07-23", "2021-08-22"),
    ("2022-09-01", "2022-08-24", "2022-09-21"),
    ("2022-10-01", "2022-09-22", "2022-10-21"),
    ("2022-11-01", "2022-10-22", "2022-11-18"),
    ("2022-12-01", "2022-11-19", "2022-12-22"),
    ("2023-01-01", "2022-12-23", "2023-01-20"),
    ("2023-02-01", "2023-01-21", "2023-02-17"),
    ("2023-03-01", "2023-02-18", "2023-03-21"),
    ("2023-04-01", "2023-03-22", "2023-05-02"),
    ("2023-05-01", "2023-05-03", "2023-05-22"),
    ("2023-06-01", "2023-05-23", "2023-06-22"),
    ("2023-07-01", "2023-06-23", "2023-07-23"),
    ("2023-08-01", "2023-07-24", "2023-08-22"),
    ("2023-09-01", "2023-08-23", "2023-09-22"),
    ("2023-10-01", "2023-09-23", "2023-10-23"),
    ("2023-11-01", "2023-10-24", "2023-11-22"),
    ("2023-12-01", "2023-11-23", "2023-12-15"),
    ("2024-01-01", "2023-12-16", "2024-01-22"),
    ("2024-02-01", "2024-01-23", "2024-02-22"),
    ("2024-03-01", "2024-02-23", "2024-03-22"),
    ("2024-04-01", "2024-03-23", "2024-04-22"),
    ("2024-05-01", "2024-04-23", "2024-05-22"),
    ("2024-06-01", "2024-05-23", "2024-06-20"),
    ("2024-07-01", "2024-06-21", "2024-07-23"),
    ("2024-08-01", "2024-07-24", "2024-08-22"),
    ("2024-09-01", "2024-08-23", "2024-09-20"),
    ("2024-10-01", "2024-09-21", "2024-10-22"),
    ("2024-11-01", "2024-10-23", "2024-11-22"),
    ("2024-12-01", "2024-11-23", "2024-12-18"),
    ("2025-01-01", "2024-12-19", "2025-01-22"),
    ("2025-02-01", "2025-01-23", "2025-02-20"),
    ("2025-03-01", "2025-02-21", "2025-03-20"),
    ("2025-04-01", "2025-03-21", "2025-04-17"),
    ("2025-05-01", "2025-04-18", "2025-05-21"),
]

# Date of each managerial file and its closing month.
FILE_MONTHS = [
    ("20201221", "2020-12-01"),
    ("20210122", "2021-01-01"),
    ("20210219", "2021-02-01"),
    ("20210322", "2021-03-01"),
    ("20210420", "2021-04-01"),
    ("20210520", "2021-05-01"),
    ("20210621", "2021-06-01"),
    ("20210721", "2021-07-01"),
    ("20210820", "2021-08-01"),
    ("20210920", "2021-09-01"),
    ("20211020", "2021-10-01"),
    ("20211122", "2021-11-01"),
    ("20211222", "2021-12-01"),
    ("20220117", "2022-01-01"),
    ("20220221", "2022-02-01"),
    ("20220322", "2022-03-01"),
    ("20220426", "2022-04-01"),
    ("20220525", "2022-05-01"),
    ("20220627", "2022-06-01"),
    ("20220721", "2022-07-01"),
    ("20220829", "2022-08-01"),
    ("20220926", "2022-09-01"),
    ("20221025", "2022-10-01"),
    ("20221128", "2022-11-01"),
    ("20221226", "2022-12-01"),
    ("20230201", "2023-01-01"),
    ("20230220", "2023-02-01"),
    ("20230322", "2023-03-01"),
    ("20230503", "2023-04-01"),
    ("20230525", "2023-05-01"),
    ("20230626", "2023-06-01"),
    ("20230724", "2023-07-01"),
    ("20230823", "2023-08-01"),
    ("20230925", "2023-09-01"),
    ("20231023", "2023-10-01"),
    ("20231123", "2023-11-01"),
    ("20231218", "2023-12-01"),
    ("20240123", "2024-01-01"),
    ("20240226", "2024-02-01"),
    ("20240325", "2024-03-01"),
    ("20240423", "2024-04-01"),
    ("20240523", "2024-05-01"),
    ("20240621", "2024-06-01"),
    ("20240724", "2024-07-01"),
    ("20240823", "2024-08-01"),
    ("20240923", "2024-09-01"),
    ("20241023", "2024-10-01"),
    ("20241122", "2024-11-01"),
    ("20241219", "2024-12-01"),
    ("20250122", "2025-01-01"),
    ("20250224", "2025-02-01"),
    ("20250320", "2025-03-01"),
    ("20250424", "2025-04-01"),
]

# Date of each HR file and the first and last termination it may report.
HR_FILE_WINDOWS = [
    ("20230308", "2000-01-01", "2022-12-31"),
    ("20230202", "2023-01-01", "2023-01-31"),
    ("20230306", "2023-02-01", "2023-02-28"),
    ("20230404", "2023-03-01", "2023-03-31"),
    ("20230503", "2023-04-01", "2023-04-30"),
    ("20230613", "2023-05-01", "2023-05-31"),
    ("20230704", "2023-06-01", "2023-06-30"),
    ("20230802", "2023-07-01", "2023-07-31"),
    ("20230901", "2023-08-01", "2023-08-31"),
    ("20231003", "2023-09-01", "2023-09-30"),
    ("20231101", "2023-10-01", "2023-10-31"),
    ("20231205", "2023-11-01", "2023-11-30"),
    ("20240103", "2023-12-01", "2023-12-31"),
    ("20240207", "2024-01-01", "2024-01-31"),
    ("20240311", "2024-02-01", "2024-02-29"),
    ("20240401", "2024-03-01", "2024-03-31"),
    ("20240514", "2024-04-01", "2024-04-30"),
    ("20240530", "2024-05-01", "2024-05-31"),
    ("20240630", "2024-06-01", "2024-06-30"),
    ("20240730", "2024-07-01", "2024-07-31"),
    ("20240831", "2024-08-01", "2024-08-31"),
    ("20240930", "2024-09-01", "2024-09-30"),
    ("20241031", "2024-10-01", "2024-10-31"),
]

# Day on which the case system was cut for each closing month.
CUT_DAYS = [
    ("2020-12-01", "2020-12-21"),
    ("2021-01-01", "2021-01-22"),
    ("2021-02-01", "2021-02-19"),
    ("2021-03-01", "2021-03-22"),
    ("2021-04-01", "2021-04-20"),
    ("2021-05-01", "2021-05-20"),
    ("2021-06-01", "2021-06-21"),
    ("2021-07-01", "2021-07-21"),
    ("2021-08-01", "2021-08-20"),
    ("2021-09-01", "2021-09-20"),
    ("2021-10-01", "2021-10-20"),
    ("2021-11-01", "2021-11-22"),
    ("2021-12-01", "2021-12-22"),
    ("2022-01-01", "2022-01-17"),
    ("2022-02-01", "2022-02-21"),
    ("2022-03-01", "2022-03-22"),
    ("2022-04-01", "2022-04-26"),
    ("2022-05-01", "2022-05-25"),
    ("2022-06-01", "2022-06-27"),
    ("2022-07-01", "2022-07-21"),
    ("2022-08-01", "2022-08-29"),
    ("2022-09-01", "2022-09-26"),
    ("2022-10-01", "2022-10-25"),
    ("2022-11-01", "2022-11-28"),
    ("2022-12-01", "2022-12-26"),
    ("2023-01-01", "2023-02-01"),
    ("2023-02-01", "2023-02-20"),
    ("2023-03-01", "2023-03-22"),
    ("2023-04-01", "2023-05-03"),
    ("2023-05-01", "2023-05-25"),
    ("2023-06-01", "2023-06-26"),
    ("2023-07-01", "2023-07-24"),
    ("2023-08-01", "2023-08-23"),
    ("2023-09-01", "2023-09-25"),
    ("2023-10-01", "2023-10-23"),
    ("2023-11-01", "2023-11-23"),
    ("2023-12-01", "2023-12-18"),
    ("2024-01-01", "2024-01-23"),
    ("2024-02-01", "2024-02-26"),
    ("2024-03-01", "2024-03-25"),
    ("2024-04-01", "2024-04-23"),
    ("2024-05-01", "2024-05-23"),
    ("2024-06-01", "2024-06-21"),
    ("2024-07-01", "2024-07-24"),
    ("2024-08-01", "2024-08-21"),
    ("2024-09-01", "2024-09-19"),
    ("2024-10-01", "2024-10-22"),
    ("2024-11-01", "2024-11-21"),
    ("2024-12-01", "2024-12-18"),
    ("2025-01-01", "2025-01-22"),
]

"""Terminations against lawsuits, and active head-count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.functions import dates, rules, text
from closeworks.functions import fixed_values as V
from closeworks.operators import aggregates, filters, periods, windows
from closeworks.operators.joins import lookup, org_lookup
from closeworks.operators.persons import identifiers, with_person
from closeworks.operators.unions import union_distinct, union_harmonized

Splits = Sequence[tuple[str, Sequence[str], str, str]]
RUN_MODES = ("teste", "previa", "fechamento")


def reported_terminations(files: Sequence[DataFrame], windows_: DataFrame) -> DataFrame:
    """Terminations of all HR files, each only within the window its file reports.

    Every file has a SOURCE that ends in `yyyyMMdd.xlsx`.
    """
    rows = union_harmonized(files)
    rows = rows.withColumns(
        {
            "DATA_ARQUIVO": F.regexp_extract("SOURCE", r"(\d{8})\.xlsx$", 1),
            "DESLIGAMENTO": dates.as_date(rows, "DESLIGAMENTO"),
            "ADMISSAO": dates.as_date(rows, "ADMISSAO"),
        }
    )
    return periods.in_source_window(filters.has_key(rows, "CPF"), "DATA_ARQUIVO", "DESLIGAMENTO", windows_)


def new_cases_by_person(book: DataFrame, managerial: DataFrame) -> DataFrame:
    """The latest new case of each tax id, with its phase group and registration number."""
    new = filters.flagged(book, "NOVOS").drop("MATRICULA", "DP_FASE")
    found = lookup(new, managerial, {"ID_PROCESSO": "PROCESSO_ID"}, {"MATRICULA": "MATRICULA"})
    found = found.withColumns(
        {
            "MATRICULA": F.regexp_replace("MATRICULA", " ", ""),
            "DP_FASE": rules.group_phase(F.col("FASE")),
            "CPF": text.tax_id_number(F.col("PARTE_CONTRARIA_CPF")),
        }
    )
    keyed = filters.has_key(found, "CPF")
    return aggregates.keep_one(keyed, ["CPF"], [F.desc("MES_FECH"), "ID_PROCESSO"])


def terminations_monthly(
    terminations: DataFrame,
    cases: DataFrame,
    units: DataFrame,
    areas: DataFrame,
    override: tuple[str, str, str] | None = None,
    splits: Splits = (),
) -> DataFrame:
    """Terminations with organisation and tenure, matched to the new case of the person.

    `cases` comes from `new_cases_by_person` and holds each tax id once.
    """
    staff = org_lookup(terminations, units, areas, "CODCCUSTOCONTABIL", "DESCRICAON1", override)
    tenure = dates.days_between(F.col("ADMISSAO"), F.col("DESLIGAMENTO"))
    known_tenure = F.when(F.col("DESLIGAMENTO") != F.lit("1900-01-01").cast("date"), tenure)
    staff = staff.withColumns(
        {
            "CPF": F.col("CPF").try_cast("bigint"),
            "MES_ADMISSAO": dates.month_start(F.col("ADMISSAO")),
            "MES_DESLIGAMENTO": dates.month_start(F.col("DESLIGAMENTO")),
            "DP_VP_DIRETORIA": rules.reporting_group(F.col("VP"), F.col("DIRETORIA"), splits),
            "TEMPO_EMPRESA": known_tenure,
            "FX_TMP_EMPRESA": rules.bin_label(tenure, V.STAFF_TENURE_BINS),
            "TIPO_CARGO": rules.title_kind(F.col("FUNCAO")),
            "TIPO_CONTRATO": rules.contract_kind(known_tenure),
        }
    )
    case_columns = {
        "DATA_DISPENSA": "DATA_DISPENSA_PROCESSO",
        "ID_PROCESSO": "ID_PROCESSO",
        "FASE": "FASE",
        "DP_FASE": "DP_FASE",
        "NOVOS": "NOVOS",
        "MES_FECH": "MES_FECH",
    }
    matched = lookup(staff, cases, "CPF", case_columns, derived=True)
    return matched.withColumns(
        {
            "MES_DATA_DISPENSA_PROCESSO": dates.month_start(F.col("DATA_DISPENSA_PROCESSO")),
            "NOVOS": F.coalesce("NOVOS", F.lit(0)),
            "FLAG_DT_DISPENSA": rules.dates_agree(
                F.col("ID_PROCESSO"), F.col("DATA_DISPENSA_PROCESSO"), F.col("DESLIGAMENTO")
            ),
            "QTDE": F.lit(1),
        }
    ).distinct()


def append_history(spark_write, result: DataFrame, mode: str) -> bool:
    """Call `spark_write(result)` unless the run is only a test or a preview."""
    if mode not in RUN_MODES:
        raise ValueError(f"mode must be one of {RUN_MODES}")
    if mode == "fechamento":
        spark_write(result)
    return mode == "fechamento"


def with_nature(terminations: DataFrame, managerial: DataFrame) -> DataFrame:
    """Operational nature by registration number, which may be written in several ways.

    A number with several natures gets a row for each of them.
    """
    nature = managerial.select(
        F.col("MATRICULA").try_cast("bigint").alias("__registration"), "NATUREZA_OPERACIONAL"
    ).filter(F.col("__registration").isNotNull()).distinct()
    numbered = terminations.withColumn("__own", F.col("MATRICULA").try_cast("bigint"))
    # Null-safe, so that a hot number can be split (see `lookup`); no number on the right is null.
    same = F.col("__own").eqNullSafe(F.col("__registration"))
    return numbered.join(nature, same, "left").drop("__own", "__registration")


def all_terminations(history: DataFrame, previews: DataFrame) -> DataFrame:
    """History and weekly previews over their common columns, each termination once."""
    rows = union_distinct(history, previews)
    rows = rows.withColumns(
        {
            "STATUS_COLABORADOR": text.replace_values(F.col("STATUS_COLABORADOR"), {"DESLIGADO-R": "DESLIGADO"}),
            "MES_ADMISSAO": dates.month_start(F.col("DATA_ADMISSAO")),
            "MES_DESLIGAMENTO": dates.month_start(F.col("DATA_DESLIGAMENTO")),
        }
    )
    key = ["MATRICULA", "STATUS_COLABORADOR", "DATA_ADMISSAO", "DATA_DESLIGAMENTO"]
    others = [c for c in rows.columns if c not in key]
    return aggregates.keep_one(rows, key, others)


def last_terminations(rows: DataFrame) -> DataFrame:
    """The last termination of each employee."""
    order = [F.desc("DATA_DESLIGAMENTO"), F.desc("DATA_ADMISSAO"), "STATUS_COLABORADOR"]
    return aggregates.keep_one(rows, ["MATRICULA"], order)


def _person(tax_id: Column) -> Column:
    """Masked tax id; one that repeats a single digit stands for no person and is null."""
    digits = text.normalize_tax_id(tax_id)
    return F.when(~digits.rlike(r"^(\d)\1*$"), text.mask_tax_id(digits))


def termination_study(
    terminations: DataFrame, book: DataFrame, managerial: DataFrame, last_only: bool = False
) -> DataFrame:
    """Terminations with every lawsuit of the person, counted once per employee (QTDE).

    The lawsuits of a person are matched on the masked tax id; ids of one repeated digit match nothing. With `last_only` an employee
    has one termination, otherwise each of them is matched.
    """
    rows = last_terminations(terminations) if last_only else terminations
    people = rows.withColumns(
        {
            "CPF": _person(F.col("CPF")),
            "MATRICULA": text.normalize_registration(F.col("MATRICULA")),
        }
    )
    extra = {"PARTE_CONTRARIA_CPF": "__cpf", "MATRICULA": "__registration"}
    cases = lookup(book, managerial, {"ID_PROCESSO": "PROCESSO_ID"}, extra)
    tax_id = F.coalesce(F.col("PARTE_CONTRARIA_CPF"), F.col("__cpf"))
    cases = cases.select(
        _person(tax_id).alias("CPF"), "ID_PROCESSO", "MES_FECH", "NOVOS"
    )
    cases = filters.has_key(cases, "CPF")
    matched = people.join(cases, "CPF", "left").withColumn("NOVOS", F.coalesce("NOVOS", F.lit(0)))
    order = ["MES_FECH", "ID_PROCESSO", "DATA_DESLIGAMENTO"]
    return windows.count_once(matched, ["MATRICULA"], order)


def termination_study_by_person(terminations: DataFrame, book: DataFrame, managerial: DataFrame) -> DataFrame:
    """As `termination_study` with every termination, but matched and counted (QTDE) by PESSOA.

    Tax ids and registrations that stand together in a termination or a lawsuit, in any spelling, belong to one person; so a person
    with two registrations is counted once, and a lawsuit that names only one of them is found. Rows without either have no PESSOA,
    match nothing and count as one.
    """
    def known(df: DataFrame, tax_id: Column, registration: Column) -> DataFrame:
        return df.withColumns({"CPF": _person(tax_id), "MATRICULA": text.normalize_registration(registration)}).withColumn(
            "__ids", identifiers({"CPF": F.col("CPF"), "MATRICULA": F.col("MATRICULA")})
        )

    extra = {"PARTE_CONTRARIA_CPF": "__cpf", "MATRICULA": "__registration"}
    cases = lookup(book.drop("MATRICULA", "CPF"), managerial, {"ID_PROCESSO": "PROCESSO_ID"}, extra)
    cases = known(cases, F.coalesce(F.col("PARTE_CONTRARIA_CPF"), F.col("__cpf")), F.col("__registration"))
    people = known(terminations, F.col("CPF"), F.col("MATRICULA"))
    people, cases = with_person([people, cases.select("__ids", "ID_PROCESSO", "MES_FECH", "NOVOS")], "__ids")
    cases = filters.has_key(cases.drop("__ids"), "PESSOA")
    matched = people.drop("__ids").join(cases, "PESSOA", "left").withColumn("NOVOS", F.coalesce("NOVOS", F.lit(0)))
    return windows.count_once(matched, ["PESSOA"], ["MES_FECH", "ID_PROCESSO", "DATA_DESLIGAMENTO"])


def active_headcount(
    files: DataFrame,
    units: DataFrame,
    areas: DataFrame,
    override: tuple[str, str, str] | None = None,
    splits: Splits = (),
    statuses: Sequence[str] = ("ATIVO", "AFASTADO"),
) -> DataFrame:
    """Active staff by cost centre, month of the file and organisation."""
    keys = ["CODCCUSTOCONTABIL", "MES_REF", "CODEMPRESA", *[f"DESCRICAON{i}" for i in range(1, 6)], "STATUS"]
    active = files.withColumn("STATUS", F.upper("STATUS")).filter(F.col("STATUS").isin(*statuses))
    grouped = aggregates.counts(active, keys, "QTD", "MATRICULA")
    found = org_lookup(grouped, units, areas, "CODCCUSTOCONTABIL", "DESCRICAON1", override)
    return found.withColumn("DP_VP_DIRETORIA", rules.reporting_group(F.col("VP"), F.col("DIRETORIA"), splits))

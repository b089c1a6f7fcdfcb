"""Classification rules as ordered conditions on columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from closeworks.functions import fixed_values as V
from closeworks.functions.text import contains_word

Bins = Sequence[tuple[float | None, float | None, str]]


def classify(col: Column, groups: Mapping[str, Sequence[str]], default: Column | None = None) -> Column:
    """Label of the group that lists the value, else `default` (null if not given)."""
    result = None
    for label, values in groups.items():
        hit = col.isin(*values)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result if default is None else result.otherwise(default)


def bin_label(value: Column, bins: Bins) -> Column:
    """Label of the half-open bin `(start, end]`; an open side is None."""
    result = None
    for start, end, label in bins:
        inside = F.lit(True)
        if start is not None:
            inside = inside & (value > start)
        if end is not None:
            inside = inside & (value <= end)
        result = F.when(inside, label) if result is None else result.when(inside, label)
    return result


def group_phase(
    col: Column, groups: Mapping[str, Sequence[str]] = V.BOOK_PHASES, null_label: str | None = None
) -> Column:
    """Phase group; an unlisted phase keeps its name.

    With `null_label` the phase is trimmed first and a missing phase gets that label.
    """
    if null_label is None:
        return classify(col, groups, default=col)
    trimmed = F.trim(col)
    return F.coalesce(classify(trimmed, groups, default=trimmed), F.lit(null_label))


def document_flag(col: Column, analyses: Sequence[str] = V.DOCUMENT_ANALYSES) -> Column:
    return F.when(col.isin(*analyses), "SIM").otherwise("NÃO")


def strategy(col: Column) -> Column:
    """Truncated spellings to the full word, other values unchanged."""
    return classify(col, V.STRATEGIES, default=col)


def strategy_label(col: Column, default: str | None = None) -> Column:
    """ACORDO where the text contains AC, DEFESA where it contains DE."""
    return (
        F.when(F.contains(col, F.lit("AC")), "ACORDO")
        .when(F.contains(col, F.lit("DE")), "DEFESA")
        .otherwise(F.lit(default))
    )


def new_or_legacy(registered: Column, cut: str = "2020-01-01") -> Column:
    return F.when(registered >= F.lit(cut).cast("date"), "NOVO").otherwise("LEGADO")


def reporting_group(
    vp: Column,
    directorate: Column,
    splits: Sequence[tuple[str, Sequence[str], str, str]],
    blank_label: str = "OUTROS",
) -> Column:
    """Reporting group of a vice-presidency.

    `splits` lists (vice-presidency, directorates, label for those, label for the others).
    A blank vice-presidency gets `blank_label`; one without a split keeps its name, and so
    does one with a split whose directorate is missing.
    """
    result = F.when(vp == "", blank_label)
    for name, directorates, label_in, label_out in splits:
        result = result.when((vp == name) & directorate.isin(*directorates), label_in)
        result = result.when((vp == name) & ~directorate.isin(*directorates), label_out)
    return result.otherwise(vp)


def case_nature(
    provision: Column,
    nature: Column,
    sub_area: Column,
    area: Column,
    strategic: Column,
    defence_first: bool = False,
) -> Column:
    """Nature of the case by priority; the model base looks at the defence flag earlier."""
    defence = [(strategic == "DEFESA", "DEFESA")]
    rest = [
        (nature == V.SOLVENT_THIRD_PARTY, V.SOLVENT_THIRD_PARTY),
        (sub_area == V.COLLECTIVE_SUB_AREA, "ESTRATEGICO"),
        (area == V.COLLECTIVE_AREA, "ESTRATEGICO"),
    ]
    result = F.when(provision > 0, "PASSÍVEL PROVISÃO")
    for condition, label in defence + rest if defence_first else rest + defence:
        result = result.when(condition, label)
    return result.otherwise("PASSÍVEL PROVISÃO")


def quarter_stock(stock: Column, month: Column) -> Column:
    return F.when((stock >= 1) & F.month(month).isin(3, 6, 9, 12), "SIM")


def closing_reason(
    closed: Column, settlement: Column, conviction_amounts: Sequence[Column]
) -> Column:
    """ACORDO, CONDENACAO or SEM ONUS of a closed case, from what was paid on it."""
    conviction = sum(conviction_amounts[1:], conviction_amounts[0])
    return F.when(
        closed == 1,
        F.when(settlement > 1, "ACORDO")
        .when(conviction > 1, "CONDENACAO")
        .when(settlement + conviction <= 1, "SEM ONUS"),
    )


def listed_title(title: Column, titles: Sequence[str] = V.BOOK_TITLES) -> Column:
    return F.when(title.isin(*titles), title).otherwise("OUTROS")


def title_synonym(title: Column) -> Column:
    return classify(title, V.TITLE_SYNONYMS, default=title)


def model_title(title: Column, nature: Column) -> Column:
    """Listed title, unless an insolvent third party is responsible."""
    return F.when(nature == V.INSOLVENT_THIRD_PARTY, V.INSOLVENT_THIRD_PARTY).otherwise(
        F.when((nature != V.INSOLVENT_THIRD_PARTY) & title.isin(*V.MODEL_TITLES), title).otherwise("OUTROS")
    )


def aging_cluster(stock_months: Column, closed_months: Column) -> Column:
    months = F.coalesce(stock_months, closed_months)
    return F.coalesce(bin_label(months, V.CLUSTER_MONTH_BINS), F.lit(V.NO_INFO))


def ministry_phase(
    party: Column, phase: Column, names: Sequence[str] | None = V.MINISTRY_PARTIES
) -> Column:
    """N/A for public ministries, given by exact names or, with None, by the word itself."""
    if names is not None:
        ministry = party.isin(*names)
    else:
        first, second = V.MINISTRY_WORDS
        ministry = F.contains(party, F.lit(first)) | F.contains(party, F.lit(second))
    return F.when(ministry, "N/A").otherwise(phase)


def title_kind(title: Column) -> Column:
    return F.when(F.contains(F.upper(title), F.lit("APRENDIZ")), "Aprendiz").otherwise("Demais Cargos")


def contract_kind(tenure_days: Column) -> Column:
    return F.when(tenure_days <= 90, "Contrato Experiência").otherwise("Contrato Normal")


def settlement_bracket(value: Column) -> Column:
    return bin_label(value, V.SETTLEMENT_BRACKETS)


def blank_reason(stock: Column, new: Column, reason: Column) -> Column:
    return F.when((stock == 1) | (new == 1), "").otherwise(reason)


def billable(analysis: Column) -> Column:
    """FATURADO, overruled by an analysis that says not to bill; null if it says neither."""
    return F.when(contains_word(analysis, "NÃO FATURAR"), "NÃO FATURADO").when(
        contains_word(analysis, "FATURAR"), "FATURADO"
    )


def late_penalty(status: Column, value: Column, discount: Column) -> Column:
    """Value after the penalty for late delivery.

    A discount below one is a share of the value, any other an amount.
    """
    applies = (status == V.LATE_STATUS) & (value > 0) & discount.isNotNull()
    reduced = F.when(discount < 1, value * (1 - discount)).otherwise(value - discount)
    return F.when(applies, reduced).otherwise(value)


def carried_status(status: Column, previous: Column, motive: Column, provision: Column) -> Column:
    """Tax status of the month, carried over from the month before.

    Open or missing statuses take the previous one, a settlement motive replaces it, and an
    open status without provision becomes a write-off.
    """
    kept = F.when(status.isNull() | status.isin(*V.OPEN_STATUSES), previous).otherwise(status)
    kept = F.when(motive == V.SETTLEMENT_MOTIVE, motive).otherwise(kept)
    return F.when(
        kept.isin(*V.OPEN_STATUSES) & (provision == 0), F.concat(kept, F.lit(V.WRITE_OFF_SUFFIX))
    ).otherwise(kept)


def dates_agree(key: Column, ours: Column, theirs: Column) -> Column:
    """1 where two dates agree, 0 where they differ, null without a match."""
    return F.when(key.isNotNull(), (ours == theirs).cast("int"))


def transition_code(phase: Column, previous: Column) -> Column:
    """0 first phase, 1 unchanged, 2 changed, 3 now closed, 4 anything else."""
    return (
        F.when(previous.isNull() & phase.isNotNull(), 0)
        .when(previous == phase, 1)
        .when((previous != phase) & (phase != V.CLOSED_PHASE), 2)
        .when(previous.isNotNull() & (phase == V.CLOSED_PHASE), 3)
        .otherwise(4)
    )


def transition_label(phase: Column, previous: Column) -> Column:
    return F.when(previous != phase, F.concat(F.trim(previous), F.lit(" - "), F.trim(phase)))

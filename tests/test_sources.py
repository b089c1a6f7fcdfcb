"""Readers and writers on temporary folders."""

import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import functions as F

from catalog import all_queries
from closeworks.plans import agency, closing
from closeworks.sources import dims, sheets, snapshots
from tests.helpers import day, rows

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _letters(column):
    text = ""
    while column >= 0:
        text, column = chr(65 + column % 26) + text, column // 26 - 1
    return text


def write_workbook(path, tabs):
    """Minimal workbook; text as shared strings, ('date', serial) as a dated number."""
    strings, parts = [], {}
    for number, grid in enumerate(tabs.values(), start=1):
        lines = []
        for r, line in enumerate(grid, start=1):
            cells = []
            for c, value in enumerate(line):
                at = f'r="{_letters(c)}{r}"'
                if value is None:
                    continue
                if isinstance(value, tuple):
                    cells.append(f'<c {at} s="1"><v>{value[1]}</v></c>')
                elif isinstance(value, str):
                    strings.append(value)
                    cells.append(f'<c {at} t="s"><v>{len(strings) - 1}</v></c>')
                else:
                    cells.append(f"<c {at}><v>{value}</v></c>")
            lines.append(f'<row r="{r}">{"".join(cells)}</row>')
        parts[f"xl/worksheets/sheet{number}.xml"] = f"<worksheet {NS}><sheetData>{''.join(lines)}</sheetData></worksheet>"
    names = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(tabs, start=1))
    links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(tabs) + 1))
    parts["xl/workbook.xml"] = f'<workbook {NS} xmlns:r="{REL}"><sheets>{names}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="{REL}">{links}</Relationships>'
    parts["xl/sharedStrings.xml"] = f"<sst {NS}>{''.join(f'<si><t>{escape(s)}</t></si>' for s in strings)}</sst>"
    parts["xl/styles.xml"] = f'<styleSheet {NS}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    with zipfile.ZipFile(path, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)


def test_workbook_tabs_become_rows(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"Dados": [["título"], ["ID", "Data", None, "Valor"], [1, ("date", 45292), None, " x "], [], [2, None, None, 2.5]]})
    grid = sheets.read_sheets(spark, str(tmp_path / "*.xlsx"))
    assert [(r["SHEET"], r["ROW_NO"], r["CELLS"]) for r in grid.orderBy("ROW_NO").collect()] == [
        ("Dados", 1, ["título"]),
        ("Dados", 2, ["ID", "Data", None, "Valor"]),
        ("Dados", 3, ["1", "2024-01-01", None, "x"]),
        ("Dados", 5, ["2", None, None, "2.5"]),
    ]
    shifted = sheets.read_sheets(spark, str(tmp_path / "*.xlsx"), start_cell="B2")
    assert [r["CELLS"] for r in shifted.orderBy("ROW_NO").collect()] == [
        ["Data", None, "Valor"], ["2024-01-01", None, "x"], [None, None, "2.5"]
    ]
    named = sheets.promote_header(sheets.read_sheets(spark, str(tmp_path / "*.xlsx"), start_cell="A2"), ["ID", "Valor", "Outra"])
    assert rows(named.select("ID", "Valor", "Outra")) == [("1", "x", None), ("2", "2.5", None)]


def test_long_tabs_come_in_batches(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"T": [[i, f"texto {i % 7}"] for i in range(3 * sheets.BATCH_ROWS + 5)]})
    grid = sheets.read_sheets(spark, str(tmp_path / "a.xlsx"))
    assert grid.agg(F.count("ROW_NO"), F.max("ROW_NO"), F.countDistinct(F.col("CELLS")[1])).first() == (
        3 * sheets.BATCH_ROWS + 5, 3 * sheets.BATCH_ROWS + 5, 7
    )


def test_books_of_several_files_and_layouts(spark, tmp_path):
    write_workbook(
        tmp_path / "05.03.2024 Fechamento.xlsx",
        {"Base Fechamento": [["x"], [None, None], ["LINHA", "NOVOS", "ESTOQUE"], [1, 1, 0], [2, None, 1]], "Outra": [["LINHA", "NOVOS"], [1, 9]]},
    )
    write_workbook(tmp_path / "02.05.2024 Fechamento.xlsx", {"Base": [["ESTOQUE", "LINHA", "Provisão"], [1, 1, 10.5]], "Base sem": [["a"], ["b"]]})
    grid = sheets.read_sheets(spark, str(tmp_path / "*.xlsx"), "Base")
    assert {r["NAME"] for r in sheets.header_names(grid, "LINHA").collect()} == {"LINHA", "NOVOS", "ESTOQUE", "Provisão"}
    columns = {"NOVOS": "NOVOS", "ESTOQUE": "ESTOQUE", "Provisão": "PROVISAO_TOTAL_PASSIVO_M"}
    book = agency.closing_workbooks(grid, columns, {"02.05.2024": "01.04.2024"})
    typed = agency.typed_closing(book, [], list(columns.values()))
    assert rows(typed) == [
        (day("2024-03-01"), 1.0, 0.0, None), (day("2024-03-01"), None, 1.0, None), (day("2024-04-01"), None, 1.0, 10.5)
    ]
    totals = agency.monthly_totals(typed.withColumn("ENCERRADOS", F.lit(0)))
    assert rows(totals) == [(day("2024-03-01"), 1.0, 0, 1.0, None), (day("2024-04-01"), None, 0, 1.0, 10.5)]


def test_inline_strings_and_wide_columns(spark, tmp_path):
    cells = '<c r="A1" t="e"><v>#N/A</v></c><c r="AB1" t="inlineStr"><is><r><t>z</t></r><r><t>w</t></r><rPh><t>no</t></rPh></is></c>'
    sheet = f'<worksheet {NS}><sheetData><row r="1">{cells}</row></sheetData></worksheet>'
    write_workbook(tmp_path / "a.xlsx", {"T": [[1]]})
    with zipfile.ZipFile(tmp_path / "a.xlsx") as old, zipfile.ZipFile(tmp_path / "b.xlsx", "w") as new:
        for name in old.namelist():
            new.writestr(name, sheet if "sheet1" in name else old.read(name))
    cells = sheets.read_sheets(spark, str(tmp_path / "b.xlsx")).first()["CELLS"]
    assert len(cells) == 28 and cells[27] == "zw" and set(cells[:27]) == {None}


def test_overwriting_replaces_only_the_written_periods(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, day("2024-01-01")), (2, day("2024-02-01"))], "v int, MES_FECH date")
    snapshots.write_period(first, path)
    snapshots.write_period(spark.createDataFrame([(3, day("2024-02-01"))], "v int, MES_FECH date"), path)
    drifted = spark.createDataFrame([(4, "x", day("2024-03-01"))], "v int, extra string, MES_FECH date")
    snapshots.write_period(drifted, path, mode="append")
    found = snapshots.read_snapshots(spark, path, merge_schema=True)
    assert rows(found.select("v", "extra", "MES_FECH")) == [
        (1, None, day("2024-01-01")), (3, None, day("2024-02-01")), (4, "x", day("2024-03-01"))
    ]
    window = snapshots.read_snapshots(spark, path, start="2024-02-01", end="2024-02-01")
    assert rows(window.select("v")) == [(3,)]
    named = snapshots.read_snapshots(spark, path, schema="v int, extra string, MES_FECH date")
    assert rows(named.select("v", "extra")) == [(1, None), (3, None), (4, "x")]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(MES_FECH" in plan


def test_one_directory_per_office(spark, tmp_path):
    df = spark.createDataFrame([(1, "Silva / Souza"), (2, "A:B?"), (3, None), (4, "A:B?")], "id int, `ESCRITÓRIO 1` string")
    snapshots.write_split(df, "ESCRITÓRIO 1", str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["ARQUIVO=AB", "ARQUIVO=Silva_-_Souza"]
    back = snapshots.read_csv(spark, str(tmp_path / "out" / "ARQUIVO=AB"), "id int, e string")
    assert sorted(r["id"] for r in back.collect()) == [2, 4]
    assert snapshots.read_csv(spark, str(tmp_path / "out" / "ARQUIVO=AB")).schema["id"].dataType.simpleString() == "int"


def test_backup_copies_by_date(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    snapshots.write_table(spark.range(3).toDF("id"), source)
    snapshots.snapshot_copy(spark, source, target, "2024-01-01")
    snapshots.snapshot_copy(spark, source, target, "2024-02-01")
    assert rows(snapshots.read_table(spark, target).groupBy("DATA_COPIA").count()) == [(day("2024-01-01"), 3), (day("2024-02-01"), 3)]


def test_period_in_the_file_name(spark):
    df = spark.createDataFrame([("HC por Status 20240531.xlsx",), ("x.xlsx",)], "f string")
    tagged = snapshots.tag_source_period(df, F.col("f"))
    assert rows(tagged.select("SOURCE", "DATA_ARQUIVO", "MES_REF")) == [
        ("HC por Status 20240531.xlsx", day("2024-05-31"), day("2024-05-01")), ("x.xlsx", None, None)
    ]
    assert snapshots.named_like(df, "f", "^HC por Status").count() == 1


def test_orders_of_every_key_have_a_file_and_tmp_is_rejected(spark, tmp_path):
    orders = [(1, "F"), (3, "P"), (4, "P"), (10, "O"), (17, None), (18, None)]
    df = spark.createDataFrame([(k, day("2024-05-31"), s) for k, s in orders], "o_orderkey long, o_orderdate date, o_orderstatus string")
    df.write.parquet(str(tmp_path / "orders.parquet"))
    found = all_queries()["source_period"](spark, str(tmp_path))
    assert rows(found.select("o_orderkey", "SOURCE")) == [
        (1, "base 20240531.xlsx"), (18, "base 20240531.xlsx"), (3, "base 20240531.csv"), (4, "base 20240531.csv")
    ]


def test_headers_are_found_while_rows_stream(spark, tmp_path):
    write_workbook(
        tmp_path / "05.03.2024 Fechamento.xlsx",
        {"Base": [["x"], ["LINHA", "NOVOS"], [1, 2], ["LINHA", 9]], "Base sem": [["a"], ["b"]]},
    )
    write_workbook(tmp_path / "sem data.xlsx", {"Base": [["NOVOS", "LINHA"], [5, 1]]})
    grid = sheets.read_sheets(spark, str(tmp_path / "*.xlsx"), marker="LINHA")
    named = sheets.promote_header(grid, ["LINHA", "NOVOS"], "LINHA")
    assert rows(named.select("LINHA", "NOVOS")) == [("1", "2"), ("1", "5"), ("LINHA", "9")]
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "Exchange" not in plan and "Join" not in plan
    slow = sheets.promote_header(sheets.read_sheets(spark, str(tmp_path / "*.xlsx")), ["LINHA", "NOVOS"], "LINHA")
    assert rows(slow) == rows(named)
    first = sheets.promote_header(sheets.read_sheets(spark, str(tmp_path / "sem data.xlsx"), marker=sheets.FIRST_ROW), ["NOVOS"])
    assert rows(first.select("NOVOS")) == [("5",)]


def test_left_out_workbooks_and_tabs_are_told(spark, tmp_path):
    write_workbook(tmp_path / "05.03.2024 F.xlsx", {"Base": [["LINHA"], [1]], "Base sem": [["a"], ["b"]]})
    write_workbook(tmp_path / "sem data.xlsx", {"Base": [["LINHA"], [5], [6]]})
    grid = sheets.read_sheets(spark, str(tmp_path / "*.xlsx"))
    assert rows(sheets.tabs_without_header(grid, "LINHA").select("SHEET", "LINHAS")) == [("Base sem", 2)]
    left = agency.undated_workbooks(grid).collect()
    assert [(r["SOURCE_FILE"].rsplit("/", 1)[-1].replace("%20", " "), r["LINHAS"]) for r in left] == [("sem data.xlsx", 3)]
    kept = agency.closing_workbooks(grid, {"LINHA": "LINHA"})
    assert kept.count() == 1


def test_payments_are_recognised_or_told(spark):
    days = ["2021-08-22", "2021-08-23", "2022-08-24", "2030-01-01", None]
    fact = spark.createDataFrame([(i, d and day(d), 1.0) for i, d in enumerate(days)], "PROCESSO_ID int, DATA_EFETIVA_DO_PAGAMENTO date, TOTAL_PAGAMENTOS double")
    calendar = dims.accounting_calendar(spark)
    told = closing.unassigned_payments(fact, calendar)
    kept = closing.recognised_payments(fact, calendar, "2025-05-01", [])
    assert rows(told.select("PROCESSO_ID")) == [(1,), (3,), (4,)] and rows(kept.select("PROCESSO_ID")) == [(0,), (2,)]

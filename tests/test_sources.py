"""Reading and writing, and the whole analysis from a CSV file."""

import datetime as dt
import sys

import pytest
from pyspark.errors import PySparkException

from ledgerlens import __main__ as command
from ledgerlens.operators import clean
from ledgerlens.plans.flows import write_analysis
from ledgerlens.session import materialise, scratch_path
from ledgerlens.sources import sales as io
from ledgerlens.sources.segments import default_segments

HEADER = '"N° da fatura","ID Cliente","Data da fatura","País","Quantidade","Valor"'


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_by_column_name(spark, tmp_path):
    path = write(
        tmp_path / "sales.csv",
        'Valor,Quantidade,País,Nota,"ID Cliente",Data da fatura,N° da fatura',
        '"139,12",6,United Kingdom,"a, b",17850,01/12/2020 08:26,536365',
        '"-22,2",-6,França,,,01/12/2020 08:28,C536366',
    )
    df = io.read_sales(spark, path)
    assert dict(df.dtypes) == {
        "amount_txt": "string",
        "quantity": "bigint",
        "country": "string",
        "Nota": "string",
        "customer_id": "bigint",
        "invoice_ts": "string",
        "invoice_no": "string",
    }
    first, second = df.orderBy("invoice_no").collect()
    assert (first.amount_txt, first.customer_id, first.Nota) == ("139,12", 17850, "a, b")
    assert (second.country, second.customer_id, second.quantity) == ("França", None, -6)


def test_csv_missing_texts_and_exported_floats(spark, tmp_path):
    path = write(
        tmp_path / "sales.csv",
        HEADER,
        '1,17850.0,d,NA,6,"1,0"',
        '2,,d,"",-6.0,nan',
        'null,NaN,,  ,7,"2,5"',
    )
    rows = [tuple(r) for r in io.read_sales(spark, path).orderBy("quantity").collect()]
    assert rows == [
        ("2", None, "d", None, -6, None),
        ("1", 17850, "d", None, 6, "1,0"),
        (None, None, None, "  ", 7, "2,5"),
    ]


def test_byte_order_mark(spark, tmp_path):
    path = write(tmp_path / "sales.csv", "\ufeff" + HEADER.replace('"', ""), '1,2,d,França,6,"1,0"')
    df = io.read_sales(spark, path)
    assert tuple(df.first()) == ("1", 2, "d", "França", 6, "1,0")


def test_ids_are_not_rounded(spark, tmp_path):
    df = io.read_sales(spark, write(tmp_path / "sales.csv", HEADER, '1,17850.5,d,France,6,"1,0"'))
    with pytest.raises(PySparkException, match="not bigint"):
        df.collect()


@pytest.mark.parametrize(
    "line", ["1,10,01/01/2021 10:00,France,5,139,12", '1,10,01/01/2021 10:00,France,5,"1,0",', "1,1,d,F,1,1,2,3,4"]
)
def test_surplus_fields_fail_whatever_is_read(spark, tmp_path, line):
    df = io.read_sales(spark, write(tmp_path / "sales.csv", HEADER, '2,2,d,France,6,"1,0"', line))
    for part in (df, df.select("country")):
        with pytest.raises(PySparkException, match="too many fields"):
            part.collect()


def test_short_lines_get_nulls(spark, tmp_path):
    df = io.read_sales(spark, write(tmp_path / "sales.csv", HEADER, "1,2,d,France"))
    assert tuple(df.first()) == ("1", 2, "d", "France", None, None)


def test_files_of_a_folder_share_their_header(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER, '1,2,d,France,3,"7,0"')
    write(tmp_path / "b.csv", HEADER, '2,2,d,France,3,"8,0"')
    assert sorted(r.amount_txt for r in io.read_sales(spark, str(tmp_path)).collect()) == ["7,0", "8,0"]
    swapped = HEADER.replace('"Quantidade","Valor"', '"Valor","Quantidade"')
    write(tmp_path / "c.csv", swapped, '3,2,d,France,"7,0",3')
    with pytest.raises(Exception, match="CSV header does not conform"):
        io.read_sales(spark, str(tmp_path)).collect()


def test_doubled_quotes(spark, tmp_path):
    path = write(tmp_path / "sales.csv", HEADER, '1,2,d,"Ilha ""Norte"", X",3,"1,0"')
    assert tuple(io.read_sales(spark, path).first()) == ("1", 2, "d", 'Ilha "Norte", X', 3, "1,0")
    back = str(tmp_path / "back")
    io.write_sales_csv(io.read_sales(spark, path), back)
    assert io.read_sales(spark, back).collect() == io.read_sales(spark, path).collect()


def test_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="country"):
        io.read_sales(spark, write(tmp_path / "bad.csv", HEADER.replace("País", "Land"), "1,1,1,1,1,1"))


def test_parquet_with_our_names(spark, tmp_path):
    path = str(tmp_path / "sales")
    raw = spark.createDataFrame(
        [("1", 2, dt.datetime(2021, 1, 1), "France", 3, "4,5")],
        "invoice_no string, customer_id long, invoice_ts timestamp_ntz, country string, quantity long, "
        "amount_txt string",
    )
    raw.write.parquet(path)
    assert io.read_sales(spark, path, "parquet").collect() == raw.collect()


def test_segments_from_csv(spark, tmp_path):
    path = write(tmp_path / "classes.csv", "id,rfm,Categoria", "0,144,Melhores clientes", "1,411,Perdidos")
    assert [tuple(r) for r in io.read_segments(spark, path).orderBy("rfm").collect()] == [
        ("144", "Melhores clientes"),
        ("411", "Perdidos"),
    ]


def test_partitioned_report(spark, tmp_path):
    path = str(tmp_path / "report")
    io.write_report(spark.range(100).selectExpr("id", "id % 3 AS part"), path, ["part"])
    assert sorted(p.name for p in (tmp_path / "report").glob("part=*")) == ["part=0", "part=1", "part=2"]
    assert io.read_report(spark, path).count() == 100


def test_replacing_a_folder_leaves_the_others(spark, tmp_path):
    path, rows = str(tmp_path / "report"), spark.range(100).selectExpr("id", "id % 3 AS part")
    io.write_report(rows, path, ["part"], "replace")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "report").rglob("part=*/*.parquet")}
    for _ in range(2):  # safe to repeat
        io.write_report(rows.filter("part = 1 AND id < 10"), path, ["part"], "replace")
        after = {p: p.stat().st_mtime_ns for p in (tmp_path / "report").rglob("part=*/*.parquet")}
        assert {p: t for p, t in before.items() if p.parent.name != "part=1"}.items() <= after.items()
        assert not any(p in after for p in before if p.parent.name == "part=1")
        assert io.read_report(spark, path).groupBy("part").count().orderBy("part").collect() == [(0, 34), (1, 3), (2, 33)]
    io.write_report(rows.filter("false"), path, ["part"], "replace")
    assert io.read_report(spark, path).count() == 70
    with pytest.raises(ValueError, match="partition_by"):
        io.write_report(rows, path, mode="replace")


def run_command(monkeypatch, *args):
    monkeypatch.setattr(sys, "argv", ["ledgerlens", *args])
    command.main()


def test_command_line_writes_both_sides(spark, tmp_path, monkeypatch, capsys):
    lines = [HEADER, '1,1,"01/02/2021 10:00",France,2,"3,0"', '2,2,"05/03/2021 10:00",United Kingdom,1,"4,50"']
    lines += ['3,1,"2021-02-01",France,1,"3,0"', '4,2,"02/02/2021 00:00",France,1,"1.234,00"']
    source = write(tmp_path / "sales.csv", *lines)
    out = str(tmp_path / "out")
    with pytest.raises(PySparkException, match="could not be parsed"):
        run_command(monkeypatch, source, str(tmp_path / "no"), "--ts-format", "dd/MM/yyyy HH:mm")
    run_command(monkeypatch, source, out, "--ts-format", "dd/MM/yyyy HH:mm", "--as-of", "2021-04-01", "--quarantine")
    assert {"sales", "rejects", "clean_audit"} <= set(capsys.readouterr().out.split())
    rejects = {r.invoice_no: (r.invoice_ts, r.amount_txt, r.reason) for r in io.read_report(spark, f"{out}/rejects").collect()}
    assert rejects == {"3": ("2021-02-01", "3,0", "bad_date"), "4": ("02/02/2021 00:00", "1.234,00", "bad_amount")}
    assert sorted(r.invoice_no for r in io.read_report(spark, f"{out}/sales").collect()) == ["1", "2"]
    audit = {r.step: r.rows for r in io.read_report(spark, f"{out}/clean_audit").collect()}
    assert audit == {"raw": 4, "drop_negative": 4, "drop_duplicates": 4, "drop_missing": 4}


def test_now_is_the_default_time(spark, tmp_path, monkeypatch):
    class Clock(dt.datetime):
        @classmethod
        def now(cls, tz=None):
            return cls(2021, 3, 9, 7, 30)

    monkeypatch.setattr(command.dt, "datetime", Clock)
    out = str(tmp_path / "out")
    source = write(tmp_path / "sales.csv", HEADER, '1,1,"01/03/2021 08:00",France,2,"3,0"', '2,2,"09/03/2021 07:00",France,1,"4,0"')
    run_command(monkeypatch, source, out, "--ts-format", "dd/MM/yyyy HH:mm")
    assert {r.customer_id: r.recency for r in io.read_report(spark, f"{out}/customers").collect()} == {1: 7, 2: 0}


def test_scratch_is_in_the_checkpoint_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert folder in scratch_path(spark, "x")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    materialise(spark.range(3))
    assert folder in spark.sparkContext.getCheckpointDir()


def test_analysis_from_csv(spark, tmp_path):
    lines = [HEADER]
    for customer in range(1, 13):
        for n in range(customer):
            invoice, country = customer * 100 + n, "United Kingdom" if n % 2 else "France"
            day = dt.datetime(2021, 1 + n % 5, customer, 8, 30).strftime("%d/%m/%Y %H:%M")
            lines.append(f'{invoice},{customer},{day},{country},{n + 1},"{customer * 10 + n},5"')
    lines += [lines[1], '9999,,"01/02/2021 00:00",France,1,"3,0"', 'C1,1,"01/02/2021 00:00",France,-1,"-3,0"']
    raw = io.read_sales(spark, write(tmp_path / "sales.csv", *lines))
    out = str(tmp_path / "out")
    as_of = dt.datetime(2021, 7, 1)
    written = write_analysis(spark, raw, default_segments(spark), out, as_of, "dd/MM/yyyy HH:mm")

    tables = {name: io.read_report(spark, f"{out}/{name}") for name in written}
    assert tables["sales"].count() == 78
    assert tables["customers"].count() == 12
    revenue = sum(c * 10 + n + 0.5 for c in range(1, 13) for n in range(c))
    for name in ("country_panorama", "segment_summary", "monthly_sales"):
        assert float(tables[name].agg({"revenue": "sum"}).first()[0]) == revenue
    mix = {r.is_home: r.n for r in tables["segments_by_home"].groupBy("is_home").agg({"customers": "sum"})
           .withColumnRenamed("sum(customers)", "n").collect()}
    assert mix == {True: 11, False: 12}
    assert tables["kpis"].first().repeat_rate == 11 / 12
    sales = clean.add_features(clean.clean_sales(raw, "dd/MM/yyyy HH:mm"))
    assert clean.split_home(sales).count() + clean.split_away(sales).count() == 78
    assert {r.rate for r in tables["retention_all"].filter("cohort_index = 1").collect()} == {1.0}
    assert not any(t.startswith("decimal") for _, t in tables["pareto_customers"].dtypes)

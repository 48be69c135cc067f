"""Readers, writers, catalog tables and HTML rows."""

from __future__ import annotations

import datetime
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from crosswind import schemas
from crosswind.functions.text import visible_text
from crosswind.operators.unions import preview, scan_tagged, union_files, union_tagged
from crosswind.session import scratch_path
from crosswind.sinks import catalog, files
from crosswind.sinks.files import load_or_build, write_csv
from crosswind.sources import files as readers
from crosswind.sources.files import read_table, scan_years
from crosswind.sources.pages import EXTRA_CARRIERS, carriers_from_rows, html_rows


def write(path: Path, *lines: str) -> str:
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_weather_file_with_index_and_any_order(spark, tmp_path):
    path = write(
        tmp_path / "weather.csv",
        ",coco,airport,time,temp,dwpt,rhum,prcp,wspd",
        "0,5.0,JFK,2018-01-01 00:00:00,-1.5,0,80.0,0.0,12.6",
        "1,,JFK,2018-01-01 01:00:00,,0,81,0.2,x",
        "2,5.5,JFK,not a time,1,0,81,0.2,3",
    )
    rows = readers.scan_weather(spark, path).collect()
    assert rows[0].asDict() == {
        "time": datetime.datetime(2018, 1, 1), "temp": -1.5, "prcp": 0.0, "rhum": 80.0,
        "wspd": 12.6, "airport": "JFK", "coco": 5,
    }
    assert (rows[1].temp, rows[1].wspd, rows[1].coco) == (None, None, None)
    assert (rows[2].time, rows[2].coco) == (None, None)


def test_carriers_keep_file_order_and_quotes(spark, tmp_path):
    path = write(tmp_path / "c.csv", "Code,Carrier", "S6,", ",JUSTICE", 'O1,"O\'Hare ""Big"", Inc"', "S6,LATER")
    df = readers.scan_carriers(spark, path)
    rows = df.orderBy(readers.POSITION).collect()
    assert [(r.Code, r.Carrier) for r in rows] == [
        ("S6", None), (None, "JUSTICE"), ("O1", 'O\'Hare "Big", Inc'), ("S6", "LATER"),
    ]


def test_whitelist_types(spark, tmp_path):
    path = write(
        tmp_path / "w.csv", "ORIGIN,AIRPORT,WEATHER_NULL_RATIO,PASSENGERS,FREIGHT_TONS", "ATL,Atlanta,0.08,381,145"
    )
    assert tuple(readers.scan_whitelist(spark, path).first()) == ("ATL", "Atlanta", 0.08, 381, 145)


def test_years_from_the_first_wanted_one(spark, tmp_path):
    write(tmp_path / "2017.csv", "broken")
    write(tmp_path / "2018.csv", "FL_DATE,ORIGIN,DEP_TIME", "2018-05-01,JFK,905.0")
    write(tmp_path / "2019.csv", "ORIGIN,FL_DATE,DEP_TIME,EXTRA", "ATL,2019-05-01,,1")
    (tmp_path / "year=2020").mkdir()
    write(tmp_path / "year=2020" / "part-0.csv", "DEP_TIME,FL_DATE", "5,2020-05-01")
    write(tmp_path / "notes.csv", "ORIGIN", "BAD")
    write(tmp_path / "_hidden.csv", "ORIGIN", "BAD")
    schema = schemas.columns("FL_DATE date, ORIGIN string, DEP_TIME double")
    rows = readers.scan_years(spark, str(tmp_path), 2018, schema).orderBy("FL_DATE").collect()
    assert [tuple(r) for r in rows] == [
        (datetime.date(2018, 5, 1), "JFK", 905.0),
        (datetime.date(2019, 5, 1), "ATL", None),
        (datetime.date(2020, 5, 1), None, 5.0),
    ]
    with pytest.raises(ValueError):
        readers.scan_years(spark, str(tmp_path), 2021, schema)


def test_scan_reads_only_wanted_columns(spark, tmp_path):
    df = spark.range(3).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    path = str(tmp_path / "t.parquet")
    df.write.parquet(path)
    scanned = readers.read_table(spark, path, schemas.columns("a long"))
    assert "ReadSchema: struct<a:string>" in scanned._jdf.queryExecution().executedPlan().toString()


WIKI = """<table class="wikitable sortable"><tbody><tr><th>A</th></tr>
<tr><td>Alaska</td><td>img</td><td>AS
</td><td>ASA</td><td><a href="/x">ALASKA</a> <i>&amp; co</i>&nbsp;</td><td>more</td></tr>
<TR><TD>short</TD></TR>
<tr><td>-</td><td>-</td><td>VX</td><td>VRD</td><td>OLD</td></tr></tbody></table>
<table class="other"><tr></tr><tr><td>1</td><td>2</td><td>NO</td><td>4</td><td>5</td></tr></table>"""
LATER = """<table class="wikitable sortable"><tr><th>A</th></tr>
<tr><td>1</td><td>2</td><td>AS</td><td>ASA</td><td>ALASKA II</td></tr></table>"""


def test_rows_of_html_tables(spark):
    pages = spark.createDataFrame([(1, WIKI), (2, LATER), (3, None), (4, "<p>none</p>")], "page_id long, html string")
    rows = html_rows(pages).orderBy("page_id", "row_no").collect()
    assert [tuple(r) for r in rows] == [
        (1, 0, 1, "AS", "ASA", "ALASKA & co"),
        (1, 0, 3, "VX", "VRD", "OLD"),
        (2, 0, 1, "AS", "ASA", "ALASKA II"),
    ]
    carriers = {r.Code: r.Carrier for r in carriers_from_rows(html_rows(pages)).collect()}
    assert carriers == {"AS": "ALASKA II"} | EXTRA_CARRIERS


def test_visible_text(spark):
    df = spark.createDataFrame([(" <b>a</b><!-- x > y -->\n &lt;b&gt; &amp;lt; ",)], "h string")
    assert df.select(visible_text(F.col("h"))).first()[0] == "a\n <b> &lt;"


def test_text_lists(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("a b",)], "x string")
    files.write_lines(df, "x", str(tmp_path / "lines"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == ["a", "a b", "b"]
    files.write_failure_list(df, "x", str(tmp_path / "failed"))
    parts = sorted((tmp_path / "failed").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "a,\na b,\nb\n"
    assert files.failure_lines(df.limit(0), "x").count() == 0


def test_parquet_in_one_file_and_counted(spark, tmp_path):
    df = spark.range(1000).repartition(4)
    files.write_parquet(df, str(tmp_path / "one"), files=1)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    files.write_parquet(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("part-*"))) == 4
    files.write_parquet(df.withColumn("k", F.col("id") % 2), str(tmp_path / "by"), partition_by=("k",))
    assert len(list((tmp_path / "by").glob("k=*/part-*"))) == 2
    assert files.write_counted(df, str(tmp_path / "counted")) == 1000
    assert spark.read.parquet(str(tmp_path / "counted")).count() == 1000


def test_load_or_build_builds_once_and_again_if_unfinished(spark, tmp_path):
    path, calls = str(tmp_path / "data"), []

    def build():
        calls.append(1)
        return spark.range(5)

    assert files.load_or_build(spark, path, build).count() == 5
    assert files.load_or_build(spark, path, build).count() == 5
    assert len(calls) == 1
    (tmp_path / "data" / "_SUCCESS").unlink()
    assert files.load_or_build(spark, path, build).count() == 5
    assert len(calls) == 2


def test_tables_by_name(spark, tmp_path):
    source = str(tmp_path / "src.parquet")
    spark.createDataFrame([(1, "x", 2.0)], "A int, b string, c double").write.parquet(source)
    location = scratch_path(spark, "t")
    catalog.table_from_parquet(spark, "by_name", source, location=location)
    assert spark.table("by_name").count() == 0
    catalog.load_by_name(spark.createDataFrame([("y", 5)], "B string, a int"), "by_name")
    catalog.load_by_name(spark.read.parquet(source), "by_name")
    rows = sorted(map(tuple, spark.table("by_name").select("A", "b", "c").collect()))
    assert rows == [(1, "x", 2.0), (5, "y", None)]
    with pytest.raises(Exception, match="(?i)column"):
        catalog.load_by_name(spark.createDataFrame([(1, 2)], "a int, z int"), "by_name")
    catalog.replace_table_as(spark.range(3), "by_name", location=location)
    assert [c for c in spark.table("by_name").columns] == ["id"]
    spark.sql("DROP TABLE by_name")


def test_a_table_is_replaced_at_once_or_not_at_all(spark, tmp_path, monkeypatch):
    location = str(tmp_path / "it's here")
    names = lambda: sorted(p.name for p in Path(location).iterdir())
    values = lambda df: sorted(tuple(r) for r in df.collect())
    catalog.replace_table_as(spark.range(3), "swapped", location=location)
    before = spark.table("swapped")
    # A reader that has begun, and a query that reads what it replaces.
    catalog.replace_table_as(spark.table("swapped").selectExpr("id + 10 AS id"), "swapped", location=location)
    assert values(before) == [(0,), (1,), (2,)]
    assert values(spark.table("swapped")) == [(10,), (11,), (12,)]

    # Killed between the write and the switch, and in the midst of the write.
    with monkeypatch.context() as patch:
        patch.setattr(catalog, "point_table", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            catalog.replace_table_as(spark.range(99), "swapped", location=location)
    with pytest.raises(Exception, match="broken"):
        rows = spark.range(5).selectExpr("IF(id = 4, raise_error('broken'), id) AS id")
        catalog.replace_table_as(rows.select(F.col("id").cast("long").alias("id")), "swapped", location=location)
    assert values(spark.table("swapped")) == [(10,), (11,), (12,)]

    # Other columns, folders by value, and back; old versions go, but for the last.
    catalog.replace_table_as(spark.range(2).selectExpr("id", "id % 2 AS part"), "swapped", location=location)
    catalog.replace_table_as(spark.range(4).selectExpr("id", "id % 2 AS part"), "swapped", location=location, partition_by=("part",))
    assert values(spark.table("swapped").where("part = 1").select("id")) == [(1,), (3,)]
    catalog.replace_table_as(spark.range(1), "swapped", location=location)
    catalog.load_by_name(spark.range(7, 8), "swapped")
    assert values(spark.table("swapped")) == [(0,), (7,)]
    complete = [n for n in names() if Path(location, n, "_SUCCESS").exists()]
    assert len(complete) == 2 and complete[-1] == names()[-1]
    spark.sql("DROP TABLE swapped")


def test_views_are_replaced(spark):
    catalog.replace_view(spark.range(3), "v_rows")
    catalog.replace_sql_view(spark, "v_sum", "WITH t AS (SELECT sum(id) AS s FROM v_rows) SELECT s FROM t")
    assert spark.table("v_sum").first().s == 3
    catalog.replace_sql_view(spark, "v_sum", "SELECT max(id) AS m FROM v_rows")
    assert spark.table("v_sum").first().m == 2


def test_rename_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, 2)], "Dep int, other int")
    assert catalog.rename_column(df, "dep", "x").columns == ["Dep", "other"]
    assert catalog.rename_column(df, "Dep", "dep").columns == ["dep", "other"]


def test_unions_and_preview(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2, True)], "s string, n int, extra boolean")
    assert sorted(union_files([a, b]).collect(), key=str) == [(1, "x", None), (2, "y", True)]
    assert {(r.n, r.airport) for r in union_tagged({"JFK": a, "ATL": a}).collect()} == {(1, "JFK"), (1, "ATL")}
    assert [r.id for r in preview(spark.range(100), ["id"]).collect()] == list(range(10))


def test_csv_comes_back_as_it_was_written(spark, tmp_path):
    texts = [" lead", "trail ", "", None, 'a "quote"', "a,b", "a\\b", "#c", "\ttab", "é 漢", '""', "null"]
    rows = [(i, t, t) for i, t in enumerate(texts)]
    kinds = StructType([StructField("n", LongType()), StructField("a", StringType()), StructField("b", StringType())])
    write_csv(spark.createDataFrame(rows, kinds), str(tmp_path / "t.csv"))
    back = read_table(spark, str(tmp_path / "t.csv"), kinds).collect()
    assert sorted(map(tuple, back)) == rows

    broken = [(1, "a\nb", "x\r\ny"), (2, 'c "\n" d', None)]
    with pytest.raises(Exception, match="line break"):
        write_csv(spark.createDataFrame(broken, kinds), str(tmp_path / "u.csv"))
    write_csv(spark.createDataFrame(broken, kinds), str(tmp_path / "u.csv"), multiline=True)
    back = read_table(spark, str(tmp_path / "u.csv"), kinds, multiline=True).collect()
    assert [(r.n, (r.a or "").replace("\r\n", "\n")) for r in sorted(back)] == [(1, "a\nb"), (2, 'c "\n" d')]


def test_files_of_a_folder_keep_their_own_headers(spark, tmp_path):
    kinds = StructType([StructField(c, StringType()) for c in ("FL_DATE", "ORIGIN", "DEST")])
    for year, files in {"2020": ["FL_DATE,ORIGIN,DEST\n1,JFK,ORD\n", "FL_DATE,DEST,ORIGIN\n2,ATL,LAX\n", "DEST,FL_DATE\nSEA,3\n"]}.items():
        folder = tmp_path / f"year={year}"
        folder.mkdir()
        for i, text in enumerate(files):
            (folder / f"{i}.csv").write_text(text)
        (folder / "empty.csv").write_text("")
    expected = [("1", "JFK", "ORD"), ("2", "LAX", "ATL"), ("3", None, "SEA")]
    assert sorted(map(tuple, scan_years(spark, str(tmp_path), 2020, kinds).collect())) == expected
    assert sorted(map(tuple, read_table(spark, str(tmp_path / "year=2020"), kinds).collect())) == expected


def test_results_of_another_recipe_are_built_anew(spark, tmp_path):
    built = []

    def build(n: int):
        return lambda: built.append(n) or spark.createDataFrame([(n,)], "n int")

    path = str(tmp_path / "kept")
    for n, recipe in ((1, "a"), (2, "a"), (3, "b"), (4, "b")):
        value = load_or_build(spark, path, build(n), recipe=recipe).first().n
        assert value == {1: 1, 2: 1, 3: 3, 4: 3}[n]
    assert built == [1, 3]


def test_tags_follow_from_the_files(spark, tmp_path):
    for name in ("JFK", "ATL"):
        spark.createDataFrame([(1, name)], "n int, own string").write.parquet(str(tmp_path / name))
    paths = {name: f"file://{tmp_path}/{name}" for name in ("JFK", "ATL")}
    tagged = scan_tagged(spark, paths)
    assert sorted((r.own, r.airport) for r in tagged.collect()) == [("ATL", "ATL"), ("JFK", "JFK")]
    assert tagged._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize(
    "table",
    [
        "<table class='wikitable sortable'>{rows}</table>",
        '<TABLE id=x class = "wikitable sortable" border>{rows}</TABLE>',
        '<table class="other"><tr><td>no</table><table class="wikitable sortable">{rows}',
    ],
)
@pytest.mark.parametrize(
    "row",
    [
        "<tr><td>-</td><td>-</td><td>{0}</td><td>x</td><td>{1}</td></tr>",
        "<tr><td>-<td>-<td>{0}<td>x<td>{1}",
        "<tr><td>-</td><td><table><tr><td>in<td>ner</table></td><td>{0}<td>x<td>{1}</tr>",
    ],
)
def test_rows_of_ordinary_html(spark, table, row):
    head = "<tr><th>a<th>b</tr>"
    rows = head + row.format("AA", "Am&eacute;rica &#8211; &#x27;x&apos; &amp;lt; &unknown; &copy;") + row.format("BB", "B")
    pages = spark.createDataFrame([(1, table.format(rows=rows))], "page_id long, html string")
    out = [(r.iata, r.icao, r.name) for r in html_rows(pages).orderBy("row_no").collect()]
    assert out == [("AA", "x", "América – 'x' &lt; &unknown; ©"), ("BB", "x", "B")]


@pytest.mark.parametrize("depth", [1, 4, 5, 30])
def test_tables_inside_tables(spark, depth):
    """However deep they lie, the rows around and behind them are right."""
    cell = "<td>-</td><td>-</td><td>{0}</td><td>x</td><td>{1}</td>"
    deep = "in" + "<TABLE class='wikitable sortable'><tr><td>".join(["-"] * (depth + 1)) + "</td></tr></table >" * depth + "out"
    rows = "<tr><th>h</tr>" + "".join(f"<tr>{cell.format(*r)}</tr>" for r in (("AA", deep), ("BB", "B")))
    html = f"</table><table class='wikitable sortable'>{rows}</table><table class=no><tr>{cell.format('NO', 'NO')}</table>"
    pages = spark.createDataFrame([(1, html * 2), (2, html.replace("</table>", "", depth + 1)), (3, "x"), (4, None)], "page_id long, html string")
    out = [(r.page_id, r.block_no, r.iata, " ".join(r.name.split())) for r in html_rows(pages).orderBy("page_id", "block_no", "row_no").collect()]
    text = "in" + " ".join(["-"] * (depth + 1)) + " out"
    assert [o for o in out if o[0] == 1] == [(1, block, *row) for block in (0, 1) for row in (("AA", text), ("BB", "B"))]
    # In a page whose tables are not closed, the row before the first end still stands.
    assert [o[2] for o in out if o[0] == 2][:1] == ["AA"]
    assert {o[0] for o in out} == {1, 2}


def test_tags_by_the_longest_path(spark, tmp_path):
    """Partitioned folders, blanks, other scripts, and a dataset inside another."""
    df = spark.createDataFrame([(1, "x y"), (2, "é")], "n int, kind string")
    paths = {"outer": tmp_path / "data sets", "inner": tmp_path / "data sets" / "kind=inside", "東京": tmp_path / "東 京+%20"}
    df.write.partitionBy("kind").parquet(str(paths["outer"]))
    df.select("n").limit(1).write.parquet(str(paths["inner"]))
    df.write.partitionBy("kind").parquet(str(paths["東京"]))
    tagged = scan_tagged(spark, {n: str(p) for n, p in paths.items() if n != "inner"}, columns=["n"], folders=("kind",))
    expected = [(1, "x y", "outer"), (1, "inside", "outer"), (2, "é", "outer"), (1, "x y", "東京"), (2, "é", "東京")]
    assert sorted(map(tuple, tagged.collect())) == sorted(expected)
    inner = scan_tagged(spark, {n: f"file://{p}" for n, p in paths.items()}, columns=["n"], folders=("kind",))
    assert {r.airport: r.n for r in inner.where("kind = 'inside'").collect()} == {"inner": 1}


def test_a_file_without_a_tag_is_an_error(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a" / "b"))
    with pytest.raises(Exception, match="no tag for"):
        scan_tagged(spark, {"x": str(tmp_path / "a" / "*")}).collect()


def test_headers_of_compressed_files(spark, tmp_path):
    import gzip

    kinds = StructType([StructField(c, StringType()) for c in ("ORIGIN", "DEST")])
    for name, text in {"a.csv.gz": "ORIGIN,DEST\nJFK,ORD\n", "b.csv.gz": "DEST,ORIGIN\nATL,LAX\n"}.items():
        (tmp_path / name).write_bytes(gzip.compress(text.encode()))
    assert sorted(map(tuple, read_table(spark, str(tmp_path), kinds).collect())) == [("JFK", "ORD"), ("LAX", "ATL")]


def jobs_of(spark, work):
    """What some work gives, and how many jobs it ran."""
    group = f"counted-{scratch_path(spark)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def many_files(folder: Path, n: int) -> list[tuple]:
    """Files of three headers, one of them rare and one with a column the others lack."""
    folder.mkdir()
    expected = []
    for i in range(n):
        if i % 50 == 7:
            text = f"DEST,X,ORIGIN\nd{i},x,o{i}\n"
        elif i % 3:
            text = f"ORIGIN,DEST\no{i},d{i}\n"
        else:
            text = f'"DEST",ORIGIN\n"d{i}",o{i}\n'
        (folder / f"{i}.csv").write_text(text)
        expected.append((f"o{i}", f"d{i}"))
    return sorted(expected)


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    kinds = StructType([StructField(c, StringType()) for c in ("ORIGIN", "DEST")])
    counts = []
    for n in (40, 2000):
        expected = many_files(tmp_path / str(n), n)
        scanned, jobs = jobs_of(spark, lambda: read_table(spark, str(tmp_path / str(n)), kinds))
        counts.append(jobs)
        assert sorted(map(tuple, scanned.collect())) == expected
        plan = scanned._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(" csv") == 1 and "Union" not in plan
    # Spark lists many files by a job of its own, once for each of the three readers.
    assert counts[1] <= counts[0] + 3


@pytest.mark.parametrize("schemes", [readers.OPENED_SCHEMES, ()])
def test_headers_of_large_files(spark, tmp_path, monkeypatch, schemes):
    """By tasks that open files, and by Spark where tasks cannot."""
    import gzip

    monkeypatch.setattr(readers, "SMALL_FILE", 1000)
    monkeypatch.setattr(readers, "OPENED_SCHEMES", schemes)
    line = "o" * 500 + ",d\n"
    for name, header in (("a", "ORIGIN,DEST\n"), ("b +é", "DEST,ORIGIN\r\n"), ("c", "ORIGIN,DEST\n")):
        (tmp_path / f"{name}.csv").write_bytes((header + line * 20_000).encode())
    (tmp_path / "d.csv.gz").write_bytes(gzip.compress(("DEST,ORIGIN\n" + "".join(f"d{i * i},o{i}\n" for i in range(2000))).encode()))
    (tmp_path / "small.csv").write_text("ORIGIN,DEST\no,d\n")
    headers = {unquote(r.file.rsplit("/", 1)[-1]): r.header for r in readers.file_headers(spark, [str(tmp_path)]).collect()}
    same, turned = "ORIGIN,DEST", "DEST,ORIGIN"
    assert headers == {"a.csv": same, "b +é.csv": turned, "c.csv": same, "d.csv.gz": turned, "small.csv": same}
    kinds = StructType([StructField(c, StringType()) for c in ("ORIGIN", "DEST")])
    back = read_table(spark, str(tmp_path), kinds)
    assert back.where("ORIGIN LIKE 'o%' AND length(ORIGIN) = 500").count() == 40_000
    assert back.where("length(DEST) = 500 AND ORIGIN = 'd'").count() == 20_000
    assert back.where("ORIGIN RLIKE '^o[0-9]*$' AND DEST RLIKE '^d[0-9]*$'").count() == 2001


def test_only_the_heads_of_large_files_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "SMALL_FILE", 1000)
    (tmp_path / "a.csv").write_bytes(b"A,B\n" + b"x,y\n" * 1000 + b"\xff\n")
    (tmp_path / "b.csv").write_text("B,A\n")
    plan = spark.read.text(str(tmp_path)).where(F.col("_metadata.file_size") <= 1000)
    assert [r.value for r in plan.collect()] == ["B,A"]
    text = plan._jdf.queryExecution().executedPlan()
    assert text.collectLeaves().head().metrics().get("numFiles").get().value() == 1


def test_header_names(spark, tmp_path):
    assert readers.column_names('a,,"b ""c"", d",A, x') == ["a0", "_c1", 'b "c", d', "A3", " x"]
    assert readers.column_names("") == []
    (tmp_path / "one.csv").write_text("ORIGIN,dest\no,d\n")
    (tmp_path / "two.csv").write_text("DEST,Origin,DEST\nd,o,e\n")
    raw = readers.read_text_columns(spark, str(tmp_path))
    assert raw.columns == ["ORIGIN", "dest", "DEST0", "DEST2"]
    assert sorted(map(tuple, raw.collect()), key=str) == [("o", "d", None, None), ("o", None, "d", "e")]


def test_folders_name_columns_too(spark, tmp_path):
    for year, city, text in ((2020, "a b", "n\n1\n"), (2021, "c%3Ad+é", "m,n\n3,2\n")):
        folder = tmp_path / f"year={year}" / f"city={city}"
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text(text)
    back = read_table(spark, str(tmp_path), schemas.columns("n long, year long, city string")).collect()
    assert sorted(map(tuple, back)) == [(1, 2020, "a b"), (2, 2021, "c:d+é")]


def test_no_files_give_no_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert readers.read_text_columns(spark, str(tmp_path)).count() == 0


def test_files_are_loaded_once(spark, tmp_path, monkeypatch):
    source, location = tmp_path / "delivered files", str(tmp_path / "loaded table")
    values = lambda: sorted(tuple(r) for r in spark.table("loads").select("a", "b").collect())
    load = lambda **how: catalog.load_files(spark, "loads", str(source), **how)
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(str(source / "one"))
    catalog.loaded_table(spark.read.parquet(str(source / "one")), "loads", location)
    assert load() >= 1
    assert load() == 0
    assert values() == [(1, "x")]

    # Names in another order and case, a column that is missing, and files without rows.
    spark.createDataFrame([("y", 2)], "B string, A int").coalesce(1).write.parquet(str(source / "two"))
    spark.createDataFrame([(3,)], "a int").coalesce(1).write.parquet(str(source / "three"))
    spark.createDataFrame([], "a int, b string").coalesce(1).write.parquet(str(source / "none"))
    assert load() >= 3
    assert load() == 0
    assert values() == [(1, "x"), (2, "y"), (3, None)]

    # Killed before the rows are written, and between the rows and the catalog.
    spark.createDataFrame([(4, "z")], "a int, b string").coalesce(1).write.parquet(str(source / "four"))
    with pytest.raises(KeyboardInterrupt):
        load(read=lambda paths: (_ for _ in ()).throw(KeyboardInterrupt))
    assert len(values()) == 3
    assert load() >= 1
    assert values() == [(1, "x"), (2, "y"), (3, None), (4, "z")]
    newest = spark.sql("SHOW PARTITIONS loads").join(
        catalog.loaded_files(spark, "loads").where("path LIKE '%/four/%'").selectExpr("'load_id=' || load_id AS partition").distinct(),
        "partition",
    ).first()[0]
    left = Path(location, newest)
    kept = sorted((p.name, p.read_bytes()) for p in left.iterdir() if p.suffix == ".parquet")
    spark.sql(f"ALTER TABLE loads DROP PARTITION (load_id = '{newest.split('=')[1]}')")
    left.mkdir(exist_ok=True)
    for name, content in kept:
        (left / name).write_bytes(content)
    assert len(values()) == 3
    assert load() >= 1
    assert values() == [(1, "x"), (2, "y"), (3, None), (4, "z")]

    # A file written anew is another one; force loads what was loaded before.
    spark.createDataFrame([(5, "long enough to differ")], "a int, b string").coalesce(1).write.mode("overwrite").parquet(str(source / "four"))
    assert load() >= 1
    assert [a for a, _ in values()] == [1, 2, 3, 4, 5]
    assert load(force=True) >= 4
    assert [a for a, _ in values()] == [1, 1, 2, 2, 3, 3, 4, 5, 5]
    assert load() == 0

    # A column that the table lacks is an error, and loads nothing.
    spark.createDataFrame([(6, 7)], "a int, other int").coalesce(1).write.parquet(str(source / "five"))
    with pytest.raises(Exception, match="(?i)column"):
        load()
    assert len(values()) == 9
    with pytest.raises(ValueError, match="loaded_table"):
        spark.range(1).write.mode("overwrite").saveAsTable("plain_rows")
        catalog.load_files(spark, "plain_rows", str(source))
    spark.sql("DROP TABLE loads")
    spark.sql("DROP TABLE plain_rows")

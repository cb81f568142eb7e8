"""Archives by members, workbooks, footers and counters on hand-made files."""

import io
import os
import zipfile
from collections import Counter

import pyarrow as pa
import pytest
from marketloom.operators import coverage
from marketloom.sources import archives, readers, sinks, workbooks
from pyspark.sql import functions as F


class Counting(io.BufferedReader):
    read_bytes = 0

    def read(self, *a):
        out = super().read(*a)
        Counting.read_bytes += len(out)
        return out


def test_only_asked_members_are_read(tmp_path, monkeypatch):
    big = os.urandom(9 << 20)
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(4):
            z.writestr(f"big{k}", big)
        z.writestr("small", "x" * 100)
    monkeypatch.setattr(archives, "opened", lambda path: Counting(io.FileIO(path)))
    asked = lambda *names: pa.RecordBatch.from_pydict({c: [r[c] for r in found if r["member"] in names] for c in ("path", "member", "offset")})
    found = [r for b in archives._directories([pa.RecordBatch.from_pydict({"path": [str(tmp_path / "a.zip")]})]) for r in b.to_pylist()]
    assert [(r["member"], r["size"]) for r in found] == [*((f"big{k}", len(big)) for k in range(4)), ("small", 100)] and Counting.read_bytes < 100_000
    Counting.read_bytes = 0
    parts = [r for b in archives._contents([asked("big2")]) for r in b.to_pylist()]
    assert b"".join(r["content"] for r in parts) == big and [r["part"] for r in parts] == [0, 1, 2] and max(len(r["content"]) for r in parts) == archives.PART
    assert Counting.read_bytes < len(big) + 200_000
    Counting.read_bytes = 0
    assert [r["content"] for b in archives._contents([asked("small")]) for r in b.to_pylist()] == [b"x" * 100] and Counting.read_bytes < 100_000


def test_archives_with_faults(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/", "")
        z.writestr("empty", "")
        z.writestr("same", "first")
        with pytest.warns(UserWarning):
            z.writestr("same", "second")
        z.writestr("broken", "to be broken")
    raw = (tmp_path / "a.zip").read_bytes().replace(b"to be broken", b"to be BROKEN", 1)
    (tmp_path / "a.zip").write_bytes(raw)
    (tmp_path / "b.zip").write_bytes(b"no archive")
    members = archives.members(spark, f"file://{tmp_path}")
    assert Counter((r.path[-5:], r.member, r.error is None) for r in members.collect()) == Counter({("a.zip", "empty", True): 1, ("a.zip", "same", True): 2, ("a.zip", "broken", True): 1, ("b.zip", None, False): 1})
    got = Counter((r.member, r.content and bytes(r.content), r.error is None) for r in archives.contents(members).collect())
    assert got == Counter([("empty", b"", True), ("same", b"first", True), ("same", b"second", True), ("broken", None, False)])
    assert archives.contents(members.limit(0)).count() == 0 and archives.members(spark, f"file://{tmp_path}", "*.none").count() == 0


def test_packed_archives_round_trip(spark, tmp_path):
    rows = [(f"{a}.zip", f"m{k}", os.urandom(k * 1000)) for a in "xyz" for k in range(5)]
    archives.packed(spark.createDataFrame(rows, "archive string, member string, content binary"), f"file://{tmp_path}/out")
    found = archives.contents(archives.members(spark, f"file://{tmp_path}/out"))
    assert {(r.path.rsplit("/", 1)[1], r.member, bytes(r.content)) for r in found.collect()} == set(rows)
    assert sorted(os.listdir(tmp_path / "out")) == ["x.zip", "y.zip", "z.zip"]


SPACE = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
BOOK = {
    "[Content_Types].xml": "<Types/>", "docProps/app.xml": "<a>kept</a>", "xl/media/image1.png": "\x00png",
    "xl/workbook.xml": f'<workbook {SPACE}><sheets><sheet name="調整" sheetId="1" r:id="rId2"/><sheet name="other" sheetId="2" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="p"><Relationship Id="rId2" Type="x" Target="worksheets/sheet1.xml"/><Relationship Id="rId1" Type="x" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
    "xl/sharedStrings.xml": f'<sst {SPACE}><si><t>id</t></si><si><t xml:space="preserve"> name </t></si><si><r><t>da</t></r><r><rPr/><t>y</t></r></si></sst>',
    "xl/styles.xml": f'<styleSheet {SPACE}><numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs count="4"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>',
    "xl/worksheets/sheet1.xml": f'<worksheet {SPACE}><dimension ref="A1:C4"/><sheetData><row r="1" spans="1:3"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row><row r="2"><c r="A2"><v>2330</v></c><c r="B2" t="inlineStr"><is><t>x &amp; y</t></is></c><c r="C2" s="1"><v>45292</v></c></row>'
    '<row r="3"><c r="A3" s="2"><v>45293.5</v></c><c r="B3"/><c r="C3" t="b"><v>1</v></c></row><row r="4" ht="20"/></sheetData><pageMargins left="0.7"/></worksheet>',
    "xl/worksheets/sheet2.xml": f'<worksheet {SPACE}><sheetData><row r="7"><c r="AA7" s="3"><v>1.5</v></c><c r="AB7" t="e"><v>#N/A</v></c></row></sheetData></worksheet>',
}


def test_workbooks_read_and_patch(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in BOOK.items():
            z.writestr(name, text)
    (tmp_path / "b.xlsx").write_bytes(b"no workbook")
    read = lambda path: {(r.sheet, f"{r.column}{r.row}"): (r.kind, r.value) for r in workbooks.cells(spark, path).collect()}
    want = {
        ("調整", "A1"): ("text", "id"), ("調整", "B1"): ("text", " name "), ("調整", "C1"): ("text", "day"), ("調整", "A2"): ("number", "2330"), ("調整", "B2"): ("text", "x & y"), ("調整", "C2"): ("date", "2024-01-01"),
        ("調整", "A3"): ("date", "2024-01-02"), ("調整", "C3"): ("boolean", "TRUE"), ("other", "AA7"): ("number", "1.5"), ("other", "AB7"): ("error", "#N/A"),
    }
    path = f"file://{tmp_path}"
    assert read(path) == want
    rows = {(r.sheet, r.row): r["values"] for r in workbooks.table(workbooks.cells(spark, path)).collect()}
    assert rows == {("調整", 2): {"id": "2330", " name ": "x & y", "day": "2024-01-01"}, ("調整", 3): {"id": "2024-01-02", "day": "TRUE"}}
    changes = [(2, "A", "number", "2352", None), (2, "C", "date", "2024-02-01", None), (3, "C", "boolean", None, None), (3, "AB", "text", "wide", None), (4, "B", "boolean", "true", None), (9, "B", "text", " <a&b> ", 3)]
    changes = spark.createDataFrame([("a.xlsx", "調整", *c) for c in changes] + [("a.xlsx", "no such sheet", 1, "A", "text", "x", None)], "archive string, sheet string, row int, column string, kind string, value string, style int")
    workbooks.patch(spark, path, f"{path}/out", changes)
    want |= {("調整", "A2"): ("number", "2352"), ("調整", "C2"): ("date", "2024-02-01"), ("調整", "AB3"): ("text", "wide"), ("調整", "B4"): ("boolean", "TRUE"), ("調整", "B9"): ("text", " <a&b> ")}
    del want[("調整", "C3")]
    assert read(f"{path}/out") == want
    with zipfile.ZipFile(tmp_path / "out" / "a.xlsx") as z:
        xml = z.read("xl/worksheets/sheet1.xml").decode()
        assert {n: z.read(n).decode() for n in z.namelist() if n != "xl/worksheets/sheet1.xml"} == {n: t for n, t in BOOK.items() if n != "xl/worksheets/sheet1.xml"}
    old = BOOK["xl/worksheets/sheet1.xml"]
    assert old[old.index('<row r="1"') : old.index('<row r="2"')] in xml and '<row r="4" ht="20"><c r="B4"' in xml and '<dimension ref="A1:C9"/>' in xml and xml.endswith('</sheetData><pageMargins left="0.7"/></worksheet>')
    # a workbook without changes isn't touched
    workbooks.patch(spark, f"{path}/out", f"{path}/same", changes.limit(0))
    assert read(f"{path}/same") == want


def test_completeness_from_footers_reads_no_column(spark, tmp_path):
    rows = [("a", f"2024-01-{d:02}", k) for d in range(1, 10) for k in range(d)] + [("b", "2024-01-05", 1)]
    landed = spark.createDataFrame(rows, "dataset string, d string, k int").withColumn("d", F.col("d").cast("date"))
    landed.write.partitionBy("dataset", "d").parquet(f"{tmp_path}/t")
    expected = spark.createDataFrame([(s, f"2024-01-{d:02}") for s in "abc" for d in range(3, 20)], "dataset string, d string").withColumn("d", F.col("d").cast("date"))
    table = readers.parquet_by_footers(spark, f"{tmp_path}/t")
    counts = table.groupBy("dataset", "d").agg(F.count("*").alias("rows"))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [dataset, d]" in plan
    got = coverage.completeness_of_table(expected, table)
    assert "PushedAggregation: [COUNT(*)]" in got._jdf.queryExecution().executedPlan().toString()
    want = coverage.completeness(expected, landed)
    assert Counter(map(tuple, got.drop("rows").collect())) == Counter(map(tuple, want.collect())) and {r.dataset: r.rows for r in got.collect()} == {"a": 45, "b": 1, "c": 0}
    # other reads are as before
    assert "BatchScan" not in spark.read.parquet(f"{tmp_path}/t")._jdf.queryExecution().executedPlan().toString()


def test_counters_come_from_the_write_itself(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(seen, "id long")
    got = sinks.counted(df, lambda x: x.write.parquet(f"{tmp_path}/t"), rows=F.count("*"), even=F.count_if(F.col("id") % 2 == 0), last=F.max("id"))
    assert got == {"rows": 100, "even": 50, "last": 99} and runs.value == 100 and spark.read.parquet(f"{tmp_path}/t").count() == 100


def test_a_directory_is_read_once(tmp_path, monkeypatch):
    """However many members of an archive a task reads, its directory is read once."""
    for name in ("a.zip", "b.zip"):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for k in range(50):
                z.writestr(f"{k}.txt", f"{name} {k}")
    found = [r for n in ("a.zip", "b.zip") for b in archives._directories([pa.RecordBatch.from_pydict({"path": [str(tmp_path / n)]})]) for r in b.to_pylist()]
    reads, read = [], archives.opened
    monkeypatch.setattr(archives, "opened", lambda path: reads.append(path) or read(path))
    asked = pa.RecordBatch.from_pylist([{k: r[k] for k in ("path", "member", "offset")} for r in found])
    got = [r for b in archives._contents([asked.slice(0, 30), asked.slice(30)]) for r in b.to_pylist()]
    assert [r["content"].decode() for r in got] == [f"{n} {k}" for n in ("a.zip", "b.zip") for k in range(50)]
    assert reads == [str(tmp_path / n) for n in ("a.zip", "b.zip")]

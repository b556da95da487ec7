"""Sources, sinks and the stream."""

import zipfile

from gazetta.plans import resolve
from gazetta.sources import readers, writers
from gazetta.streaming.resolving import resolve_stream

GAZ = "ward_code string, ward string, ward_level string, district_code string, district string, district_level string, province_code string, province string, province_level string"
ROW = ("00001", "ben nghe", "phuong", "001", "1", "quan", "79", "ho chi minh", "thanh pho")


def workbook(path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="a" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>ID</t></si><si><t>ADDR</t></si></sst>")
        rows = '<row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2"><v>7</v></c><c r="B2" t="inlineStr"><is><t>ben nghe, q1, hcm</t></is></c></row><row><c r="A3"><v>8</v></c></row>'
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>")


def test_xlsx_addresses(spark, tmp_path):
    workbook(tmp_path / "a.xlsx")
    assert [tuple(r) for r in readers.read_addresses(spark, str(tmp_path / "a.xlsx"), "xlsx").collect()] == [(7, "ben nghe, q1, hcm"), (8, None)]


def test_round_trips(spark, tmp_path):
    g = spark.createDataFrame([ROW], GAZ)
    writers.write_gazetteer(writers.spaced(g), str(tmp_path / "g"))
    assert readers.read_gazetteer(spark, str(tmp_path / "g")).collect() == g.collect()
    (tmp_path / "a.csv").write_text("ID,ADDR\n1,\"ben nghe, q1, hcm\"\n")
    a = readers.read_addresses(spark, str(tmp_path / "a.csv"), "csv")
    best = resolve.resolve(a, g)
    writers.write_result(best, str(tmp_path / "r"))
    lines = spark.read.text(str(tmp_path / "r")).collect()
    assert [r.value for r in lines] == ["index;addr;ward code;ward;district code;district;province code;province;score", "1;ben nghe, q1, hcm;00001;ben nghe;001;1;79;ho chi minh;30.0"]
    assert writers.summary(best).first()[:] == (0, 1, 30.0)


def test_stream(spark, tmp_path):
    g = spark.createDataFrame([ROW], GAZ)
    readers.literal_addresses(spark, ["ben nghe, q1, hcm", "nowhere"]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("idx long, addr string").parquet(str(tmp_path / "in"))
    resolve_stream(stream, g, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert [(r.idx, r.score) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(0, 30.0)]

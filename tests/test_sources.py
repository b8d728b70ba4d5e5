import gzip
import hashlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stratagate.contract import Contract, Dialect, Field
from stratagate.operators import checks, profile
from stratagate.session import settings
from stratagate.sources import delimited, landing
from stratagate.sources.delimited import LINE, PART

from items import DIRTY, GOOD, HEADER, ITEMS, write

PLAIN = Contract("o", "b", "e", fields=tuple(Field(c) for c in "abc"), dialect=Dialect(header=False))


def scan(spark, folder, contract=PLAIN):
    return delimited.scan_rows(spark, contract, str(folder), str(folder))


def test_rows_as_text_with_malformed_lines_marked(spark, tmp_path):
    write(tmp_path / "a b+c%", "f1.CSV", '1;x;2\n2;y\n3;"a;b";4\n4;"q""w";5;6\n   \n\n5;"";7\n6;"z;1\n')
    rows = scan(spark, tmp_path).collect()
    assert {r[PART] for r in rows} == {"a b+c%/f1.CSV"}
    assert [(r.a, r.b, r.c) for r in rows if r[LINE] is None] == [
        ("1", "x", "2"), ("3", "a;b", "4"), ("5", None, "7"),
    ]
    assert {r[LINE] for r in rows if r[LINE]} == {"2;y", '4;"q""w";5;6', '6;"z;1'}


def test_malformed_alone_can_be_asked_for(spark, tmp_path):
    write(tmp_path, "f.csv", "1;2;3\n1;2\n")
    assert delimited.malformed(scan(spark, tmp_path)).select(LINE).collect()[0][0] == "1;2"
    assert delimited.part_counts(scan(spark, tmp_path)).collect()[0].asDict() == {
        "part": "f.csv", "read": 2, "malformed": 1,
    }


def test_physical_lines_leave_blank_ones_out(spark, tmp_path):
    write(tmp_path, "f.csv", "1;2;3\n\n   \n4;5;6")
    lines = delimited.scan_lines(spark, str(tmp_path), str(tmp_path))
    counts = delimited.physical_counts(lines)
    assert counts.first().physical == 2
    assert delimited.source_rows(counts, header=True).first()[0] == 1


def test_source_rows_per_part(spark):
    counts = spark.createDataFrame([("a", 11), ("b", 6)], "part string, physical bigint")
    assert delimited.source_rows(counts, True).first()[0] == 15
    assert delimited.source_rows(counts, False).first()[0] == 17
    assert delimited.source_rows(counts.where("false"), True).first()[0] == 0


@pytest.mark.parametrize("encoding,data,text", [
    ("iso-8859-1", b"\xe9;1;2\n", "é"),
    ("windows-1252", b"\x80;1;2\n", "€"),
    ("utf-8", "﻿é;1;2\n".encode(), "é"),
])
def test_encodings(spark, tmp_path, encoding, data, text):
    write(tmp_path, "f.csv", data)
    contract = Contract("o", "b", "e", fields=PLAIN.fields, dialect=Dialect(header=False, encoding=encoding))
    assert scan(spark, tmp_path, contract).first().a == text


def test_windows_bytes_are_read_in_an_untold_session(spark, tmp_path):
    """Every byte that is not a line end, in well-formed and malformed lines, under any separator."""
    key = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key, None)
    high = bytes(range(0x80, 0x100))
    shown = high.decode("windows-1252", errors="replace")
    for mark, sep in ((b";", ";"), (b"\x80", "€")):
        body = high.replace(mark, b"")
        text = shown.replace(sep, "")
        folder = tmp_path / str(len(mark) + ord(sep))
        folder.mkdir()
        (folder / "f.csv").write_bytes(body + mark + b"2" + mark + body + b"\n" + body + b"\n")
        contract = Contract(
            "o", "b", "e", fields=PLAIN.fields,
            dialect=Dialect(header=False, encoding="windows-1252", separator=sep),
        )
        rows = delimited.scan_rows(spark, contract, str(folder), str(folder)).collect()
        good = next(r for r in rows if r[delimited.LINE] is None)
        assert [good[i] for i in range(3)] == [text, "2", text]
        assert [r[delimited.LINE] for r in rows if r[delimited.LINE] is not None] == [text]
        first = delimited.measured_lines(spark, str(folder), str(folder), "windows-1252").first()
        assert (first.value, first.physical) == (f"{text}{sep}2{sep}{text}", 2)
    assert spark.conf.get(key, None) == before


def test_absent_column_stays_null(spark, tmp_path):
    write(tmp_path, "f.csv", "1;2;3\n")
    contract = Contract("o", "b", "e", fields=(*PLAIN.fields[:1], Field("gone", absent=True), *PLAIN.fields[1:]), dialect=Dialect(header=False))
    out = delimited.bronze_rows(scan(spark, tmp_path, contract), contract, "2026-09", "r")
    assert out.dtypes == contract.bronze_schema()
    assert out.first()[:4] == ("1", None, "2", "3")


def test_manifest_hashes(spark, tmp_path):
    write(tmp_path / "a b+c%", "f1.CSV", "x" * 50)
    write(tmp_path, "f2.csv", "abc")
    write(tmp_path, "a[1]*.csv", "y")
    expected = {
        "a b+c%/f1.CSV": (50, hashlib.sha256(b"x" * 50).hexdigest()),
        "f2.csv": (3, hashlib.sha256(b"abc").hexdigest()),
        "a[1]*.csv": (1, hashlib.sha256(b"y").hexdigest()),
    }
    for folder in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}/"):
        files = landing.landing_manifest(spark, str(tmp_path), folder).collect()
        assert {f.part: (f.bytes, f.sha256) for f in files} == expected


def test_digests_of_every_kind_of_file(spark, tmp_path):
    lines = b"".join(b"%d;caf\xe9;\r\n" % i for i in range(60_000))
    contents = {
        "latin.csv": lines,
        "open_end.csv": lines[:-2] + b"x",
        "marked.csv": b"\xef\xbb\xbf" + lines,
        "marked_open.csv": b"\xef\xbb\xbfone;two",
        "mark.csv": b"\xef\xbb\xbf",
        "empty file.csv": b"",
        "blank.csv": b"\n\n\r\n",
        "one_lf.csv": b"\n",
        "one_line.csv": b"\x00\xff" * 400_000,
        "not_really.gz": lines[:1000],
        "packed.csv.GZ": gzip.compress(lines),
        "sub/binary": bytes(range(256)) * 2000,
    }
    for name, data in contents.items():
        write(tmp_path / name.rpartition("/")[0], name.rpartition("/")[2], data)
    # many splits of each file
    with settings(spark, spark__sql__files__maxPartitionBytes="100000"):
        files = landing.landing_manifest(spark, str(tmp_path), str(tmp_path)).collect()
    assert {f.part: (f.path.split(":")[-1], f.bytes, f.sha256) for f in files} == {
        name: (f"{tmp_path}/{name}", len(data), hashlib.sha256(data).hexdigest()) for name, data in contents.items()
    }


def test_digests_of_no_files(spark, tmp_path):
    write(tmp_path, "empty.csv", b"")
    files = landing.landing_manifest(spark, str(tmp_path), str(tmp_path)).collect()
    assert [(f.part, f.bytes, f.sha256) for f in files] == [("empty.csv", 0, hashlib.sha256(b"").hexdigest())]


def test_odd_names_and_uris(spark, tmp_path):
    for name in ("a[1].csv", "b {2}.csv", "c+%20?.csv"):
        write(tmp_path, name, f"{name};1;2\n")
    uri = f"file://{tmp_path}"
    paths = [delimited.literal_path(f"{uri}/{n}") for n in ("a[1].csv", "b {2}.csv")]
    rows = delimited.scan_rows(spark, PLAIN, paths, uri).collect()
    assert {(r[PART], r.a) for r in rows} == {("a[1].csv",) * 2, ("b {2}.csv",) * 2}
    lines = delimited.scan_lines(spark, str(tmp_path), uri)
    assert {r[PART] for r in lines.collect()} == {"a[1].csv", "b {2}.csv", "c+%20?.csv"}


def test_lines_the_reader_skips_are_not_counted(spark, tmp_path):
    write(tmp_path, "f.csv", "1;2;3\n\t\t\n \t \n4;5;6\n")
    physical = delimited.measured_lines(spark, str(tmp_path), str(tmp_path)).first()
    assert physical.physical == 2 == scan(spark, tmp_path).count()


def test_headers_are_decoded_as_declared(spark, tmp_path):
    for encoding, name in (("iso-8859-1", "SITUAÇÃO"), ("windows-1252", "PREÇO€"), ("utf-8", "日本")):
        folder = tmp_path / encoding
        folder.mkdir()
        (folder / "f.csv").write_bytes(f"CÓDIGO;\"A \\\" B\";{name}\n1;2;3\n".encode(encoding))
        contract = Contract(
            "o", "b", "e",
            fields=(Field("a", header="CÓDIGO"), Field("b", header='A " B'), Field("c", header=name)),
            dialect=Dialect(encoding=encoding, escape="\\"),
        )
        first = delimited.first_lines(spark, str(folder), str(folder), encoding)
        assert checks.header(first, contract).collect() == []


def test_selection_ignores_case(spark):
    files = spark.createDataFrame(
        [("z/B.EMPRECSV", "/d/z/B.EMPRECSV"), ("a/A.EmpreCsv", "/d/a/A.EmpreCsv"), ("c.sociocsv", "/d/c.sociocsv")],
        "part string, path string",
    )
    assert [r.part for r in landing.select_parts(files, "*.emprecsv").collect()] == ["a/A.EmpreCsv", "z/B.EMPRECSV"]
    assert landing.select_parts(files, "[!c]*.*csv").count() == 2
    assert landing.select_parts(files, "?.sociocsv").count() == 1
    assert landing.select_parts(files, "a+b").count() == 0


def test_fingerprint_is_hash_of_sorted_lines(spark):
    parts = [("b", "2"), ("a", "9"), ("a|", "1"), ("a", "3")]
    text = "\n".join(f"{p}|{s}" for p, s in sorted(parts))
    got = landing.publication_fingerprint(spark.createDataFrame(parts, "part string, sha256 string"))
    assert got.first()[0] == hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------- profile


def survey(spark, folder, contract=ITEMS):
    raw = profile.byte_lines(spark, str(folder), str(folder), contract.split_parts)
    return profile.Survey(raw, contract)


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("data", [
    GOOD, DIRTY, GOOD.replace("\n", "\r\n"), GOOD.replace("\n", "\r"), "\ufeff" + GOOD, HEADER, HEADER + "\n \t\n\n",
    GOOD.encode().replace(b"A\n", b"\xe9\n"), GOOD.replace(";", ","), GOOD + "1;2\r\n3;4;5;6;7\n", "\n",
    HEADER + '"a;b";1;"x ""y""";3\nc;2;;4\nd;;z;5\nb;9;;\n',
])
def test_survey_tells_what_the_single_reports_tell(spark, tmp_path, data):
    write(tmp_path, "itens.csv", data)
    write(tmp_path / "sub", "more.csv", GOOD)
    at, d = str(tmp_path), ITEMS.dialect
    got, raw, lines = survey(spark, tmp_path), profile.byte_lines(spark, at, at), delimited.scan_lines(spark, at, at)
    first = delimited.first_lines(spark, at, at)
    assert rows_of(got.terminators()) == rows_of(profile.terminators(raw))
    assert rows_of(got.encoding()) == rows_of(profile.encoding(raw, d.encoding, PART))
    assert rows_of(got.separators()) == rows_of(profile.likely_separator(lines, PART))
    assert rows_of(got.widths()) == rows_of(profile.widths(lines, d, PART))
    assert rows_of(got.first()) == rows_of(first)
    problems = profile.part_problems(lines, raw, first, ITEMS)
    assert rows_of(got.problems()) == rows_of(problems)
    rows = delimited.well_formed(delimited.scan_rows(spark, ITEMS, at, at))
    columns = [f.name for f in ITEMS.source_fields]
    told = {r[:2]: r[2] for r in rows_of(profile.samples(rows, columns, PART).select(F.col(PART).alias("a"), F.col("column").alias("b"), F.col("samples").alias("c")))}
    kept = {r[:2]: r[2] for r in rows_of(got.samples().select(F.col(PART).alias("a"), F.col("column").alias("b"), F.col("samples").alias("c")))}
    assert {k: x for k, x in kept.items() if x} == {k: x for k, x in told.items() if x}
    report = got.report(problems)
    assert {r[PART] for r in report.collect()} == {r[PART] for r in raw.select(PART).collect()}


def test_survey_of_split_parts_and_scans(spark, tmp_path):
    for i in range(3):
        write(tmp_path / "one", f"f{i}.csv", "1;2;3\n" * (i + 1))
    write(tmp_path / "two", "f.csv", "1;2;3\n4;5\n")
    contract = replace(PLAIN, split_parts=True)
    got = survey(spark, tmp_path, contract)
    assert rows_of(profile.verdict(got.patterns.select(PART).distinct(), got.problems())) == [
        ("one", 0, "COMPATIVEL"), ("two", 1, "INCOMPATIVEL"),
    ]
    assert got.widths().where(f"{PART} = 'one'").collect()[0].lines == 6
    # reports read the survey's table, not the files; samples read them once more
    files = lambda df: [f for f in df.inputFiles() if f.endswith(".csv")]
    assert not any(files(df) for df in (got.terminators(), got.widths(), got.separators(), got.encoding(), got.problems()))
    assert len(files(got.samples())) == 4


def inspect(spark, folder, contract=ITEMS):
    at = str(folder)
    first = delimited.first_lines(spark, at, at)
    problems = profile.part_problems(
        delimited.scan_lines(spark, at, at), profile.byte_lines(spark, at, at), first, contract
    )
    verdict = profile.overall(profile.verdict(first, problems)).first().verdict
    return verdict, [r.problem for r in problems.orderBy("problem").collect()]


@pytest.mark.parametrize("data,verdict,problems", [
    (GOOD, "COMPATIVEL", []),
    (GOOD.replace("\n", "\r\n"), "COMPATIVEL", []),
    ("﻿" + GOOD, "COMPATIVEL", []),
    ("CODIGO;VALOR;SITUACAO;DATA\n1;2;A;3\n", "INCOMPATIVEL",
     ["column DATA at position 4, declared 3", "column SITUACAO at position 3, declared 4"]),
    (GOOD.encode().replace(b"A\n", b"\xe9\n"), "INCOMPATIVEL", ["does not decode as declared"]),
    (HEADER + "1;2;3;4\n1;2\n", "INCOMPATIVEL", ["1 of 2 records of another width"]),
    (HEADER, "INCOMPATIVEL", ["no data records"]),
])
def test_inspection(spark, tmp_path, data, verdict, problems):
    write(tmp_path, "itens.csv", data)
    assert inspect(spark, tmp_path) == (verdict, problems)


def test_utf8_declared_as_latin(spark, tmp_path):
    write(tmp_path, "f.csv", "é;1;2\n")
    latin = Contract("o", "b", "e", fields=PLAIN.fields, dialect=Dialect(header=False, encoding="iso-8859-1"))
    assert inspect(spark, tmp_path, latin) == ("INCOMPATIVEL", ["reads as UTF-8, another charset is declared"])


def test_comma_file_declared_semicolon(spark, tmp_path):
    write(tmp_path, "f.csv", "1,2,3\n4,5,6\n")
    assert inspect(spark, tmp_path, PLAIN) == (
        "INCOMPATIVEL", ["2 of 2 records of another width", "likely separator ,"],
    )


@pytest.mark.parametrize("data,kind,bom", [
    (b"a\r\nb\r\n", "CRLF", False), (b"a\nb", "LF", False), (b"a\r\nb\n", "mixed", False),
    (b"a", "undefined", False), (b"\xef\xbb\xbfa\r\nb", "CRLF", True), (b"a\r\nb", "CRLF", False),
])
def test_terminators(spark, tmp_path, data, kind, bom):
    write(tmp_path, "f.csv", data)
    got = profile.terminators(profile.byte_lines(spark, str(tmp_path), str(tmp_path))).first()
    assert (got.terminator, got.bom) == (kind, bom)


def test_width_honours_quotes(spark):
    lines = ['a;b;c', '"a;b";c', '"a;""b;";c', 'a"b;c', '"";;', '"open;c', ""]
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    got = [r[0] for r in df.select(profile.record_width(F.col("v"), Dialect())).collect()]
    assert got == [3, 2, 2, 2, 3, 1, 1]
    slash = Dialect(escape="\\")
    assert df.select(profile.record_width(F.lit('"a\\";b";c'), slash)).first()[0] == 2


def test_windows_1252_undefined_byte(spark, tmp_path):
    write(tmp_path, "bad.csv", b"\x81;1\n")
    write(tmp_path, "good.csv", b"\x80;1\n")
    lines = profile.byte_lines(spark, str(tmp_path), str(tmp_path))
    got = {r[0]: r.decodes_declared for r in profile.encoding(lines, "windows-1252", PART).collect()}
    assert got == {"bad.csv": False, "good.csv": True}


def test_dirty_fixture_width(spark, tmp_path):
    write(tmp_path, "itens.csv", DIRTY)
    lines = delimited.scan_lines(spark, str(tmp_path), str(tmp_path))
    got = {r.width: r.lines for r in profile.widths(lines, ITEMS.dialect).collect()}
    assert got == {3: 2, 4: 9, 5: 1}

import datetime as dt
import gzip
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import IntegerType, StructField, StructType

from stratum.sources.csv_splits import classified, first_rows, header_mode, is_split, numbered_first
from stratum.sources.files import corrupt_records, good_records, scan_folder, scan_with_corrupt
from stratum.sources.fixed_width import Field, scan_fixed_width
from stratum.sources.listing import files_in, recent_day_folders
from stratum.sources.tables import range_predicates, scan_table


def write(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name.replace("__", ".")), "w", encoding="utf-8") as stream:
            stream.write(text)
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_flat_discovery(spark, tmp_path):
    base = write(tmp_path / "f", a__csv="x", b__CSV="x", c__txt="x", _skip__csv="x")
    os.makedirs(tmp_path / "f" / "sub.csv")
    assert [f.name for f in files_in(spark, base, ".csv")] == ["a.csv"]
    assert [f.name for f in files_in(spark, base)] == ["a.csv", "b.CSV", "c.txt"]
    with pytest.raises(Exception):
        files_in(spark, str(tmp_path / "missing"))


def test_empty_folder_gives_no_frame(spark, tmp_path):
    os.makedirs(tmp_path / "e")
    assert scan_folder(spark, str(tmp_path / "e"), "csv") == (None, [])


def test_day_folders(spark, tmp_path):
    days = ["2023/12/31", "2024/01/01", "2024/1/2", "2024/02/28", "2024/03/01", "2025/01/01", "2024/xx/01", "notes/01/01"]
    for day in days:
        os.makedirs(tmp_path / day)
    base = str(tmp_path)

    def found(as_of, n):
        return [p.split(tmp_path.name + "/")[1] for p in recent_day_folders(spark, base, as_of, n)]

    assert found(dt.date(2024, 3, 1), 1) == ["2025/01/01", "2024/03/01"]
    assert found(dt.date(2024, 3, 1), 3) == ["2025/01/01", "2024/03/01", "2024/02/28"]
    assert found(dt.date(2024, 1, 2), 3)[-3:] == ["2024/1/2", "2024/01/01", "2023/12/31"]
    assert found(dt.date(2026, 1, 1), 1) == []


def test_without_day_folders_the_base_is_read(spark, tmp_path):
    base = write(tmp_path / "d", a__csv="id\n1\n")
    df, files = scan_folder(spark, base, "csv", {"header": True}, ".csv", last_n_days=2, as_of=dt.date(2024, 1, 1))
    assert rows(df) == [("1", "a.csv")] and len(files) == 1


def test_split_detection(spark, tmp_path):
    one = files_in(spark, write(tmp_path / "a", x_1__csv="i\n1\n"))
    two = files_in(spark, write(tmp_path / "b", x_1__csv="i\n1\n", x_2__csv="2\n"))
    assert not is_split(one) and is_split(two) and is_split(one + two)
    assert [f.name for f in numbered_first(two, ".csv")] == ["x_1.csv"]
    assert header_mode(" All_Header ") == "all_header" and header_mode("odd") == "auto" == header_mode(None)


def test_auto_with_reference_header(spark, tmp_path):
    base = write(tmp_path / "s", x_1__csv="id,v\n1,a\n", x_2__csv="id,v\n2,b\n", x_3__csv='3,"c,d"\nid,v\n',
                 x_4__csv="", x_5__csv="v,id\n")
    df, _ = scan_folder(spark, base, "csv", {}, ".csv")
    # x_3 holds a data row that looks like the header; x_5 has other names in its first row: data.
    assert rows(df) == [("1", "a", "x_1.csv"), ("2", "b", "x_2.csv"), ("3", "c,d", "x_3.csv"),
                        ("id", "v", "x_3.csv"), ("v", "id", "x_5.csv")]


def test_auto_with_illegal_reference_is_headerless(spark, tmp_path):
    base = write(tmp_path / "s", x_1__csv="a b,c\n1,2\n", x_2__csv="3,4\n")
    df, _ = scan_folder(spark, base, "csv", {}, ".csv")
    assert df.columns == ["_c0", "_c1", "file_name"] and df.count() == 3


def test_auto_without_reference(spark, tmp_path):
    base = write(tmp_path / "s", p__csv="id,v\n1,a b\n", q__csv="2,c d\n")
    files = files_in(spark, base)
    assert [[f.name for f in part] for part in classified(spark, files, {})] == [["p.csv"], ["q.csv"]]
    assert rows(scan_folder(spark, base, "csv")[0]) == [("1", "a b", "p.csv"), ("2", "c d", "q.csv")]


def test_other_modes(spark, tmp_path):
    base = write(tmp_path / "s", x_1__csv="id;v\n1;a\n", x_2__csv="id;v\n2;b\n")
    options = {"delimiter": ";", "inferSchema": "true"}
    assert scan_folder(spark, base, "csv", options, ".csv", header_mode="no_header")[0].count() == 4
    assert rows(scan_folder(spark, base, "csv", options, ".csv", header_mode="all_header")[0]) == [
        (1, "a", "x_1.csv"), (2, "b", "x_2.csv")]
    one = scan_folder(spark, base, "csv", options, ".csv", header_mode="one_header")[0]
    assert rows(one) == [(1, "a", "x_1.csv"), (2, "b", "x_2.csv"), (None, "v", "x_2.csv")]
    write(tmp_path / "t", p__csv="1\n", q__csv="2\n")
    with pytest.raises(ValueError):
        scan_folder(spark, str(tmp_path / "t"), "csv", {}, ".csv", header_mode="one_header")


def test_narrow_and_wide_headerless_rows(spark, tmp_path):
    base = write(tmp_path / "s", x_1__csv="id,v\n1,a\n", x_2__csv="2\n3,c,extra\n")
    df, _ = scan_folder(spark, base, "csv", {}, ".csv")
    assert rows(df) == [("1", "a", "x_1.csv"), ("2", None, "x_2.csv"), ("3", "c", "x_2.csv")]


def test_first_rows_of_compressed_and_odd_files(spark, tmp_path):
    base = write(tmp_path / "s", a__csv="\ufeffid,v\r\n1,2\r\n", b__csv="\n\nid,v\n", c__csv="")
    with gzip.open(tmp_path / "s" / "d.csv.gz", "wt") as stream:
        stream.write("id,v\n1,2\n")
    assert first_rows(spark, files_in(spark, base), {}) == [["id", "v"], ["id", "v"], None, ["id", "v"]]


def test_first_rows_with_line_breaks_encodings_and_odd_paths(spark, tmp_path):
    os.makedirs(tmp_path / "s p%20+é#")
    base = tmp_path / "s p%20+é#"
    (base / "a b%,é.csv").write_text('"id\nno","v""w"\n1,2\n', encoding="utf-8")
    (base / "b.csv").write_text("x" * 100_000 + ",y\n1,2\n" * 50_000, encoding="utf-8")
    files = files_in(spark, str(base))
    assert first_rows(spark, files, {"multiLine": True}) == [["id\nno", 'v"w'], ["x" * 100_000, "y"]]
    assert scan_folder(spark, str(base), "csv", {"multiLine": True}, header_mode="all_header")[0].count() > 0
    (tmp_path / "u").mkdir()
    for name, encoding in (("l.csv", "utf-16-le"), ("b.csv", "utf-16-be"), ("w.csv", "utf-16")):
        (tmp_path / "u" / name).write_bytes("é,v\n1,2\n".encode(encoding))
        assert first_rows(spark, [f for f in files_in(spark, str(tmp_path / "u")) if f.name == name], {"encoding": encoding}) == [["é", "v"]]


def test_gateway_calls_do_not_grow_with_the_files(spark, tmp_path):
    from py4j.clientserver import JavaClient

    counts = []
    for n in (5, 80):
        base = write(tmp_path / f"n{n}", **{f"x_{i}__csv": f"id,v\n{i},a\n" for i in range(1, n + 1)})
        calls, send = [0], JavaClient.send_command

        def counted(self, command, *args, **options):
            calls[0] += not command.startswith("m\n")  # releases of objects come at any time
            return send(self, command, *args, **options)

        JavaClient.send_command = counted
        try:
            df, files = scan_folder(spark, base, "csv", {}, ".csv")
        finally:
            JavaClient.send_command = send
        counts.append(calls[0])
        assert len(files) == n and df.count() == n
    assert counts[1] <= counts[0] + 10


def test_split_parts_keep_corrupt_records(spark, tmp_path):
    base = write(tmp_path / "c", x_1__csv="id,v\n1,a\n", x_2__csv="id,v\n2,b\nz,b\n", x_3__csv="3,c\n4,d,more\n")
    df, _ = scan_folder(spark, base, "csv", {}, ".csv", schema="id int, v string", keep_corrupt=True)
    assert rows(good_records(df)) == [(1, "a", "x_1.csv"), (2, "b", "x_2.csv"), (3, "c", "x_3.csv")]
    assert rows(corrupt_records(df)) == [("x_2.csv", "z,b"), ("x_3.csv", "4,d,more")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 4)), min_size=1, max_size=4), st.sampled_from(["auto", "mixed"]))
def test_split_modes_keep_every_row(spark, tmp_path_factory, parts, _):
    folder = tmp_path_factory.mktemp("split")
    files = {"p_1__csv": "id,v\n0,z\n"}
    total = 1
    for number, (header, n) in enumerate(parts, 2):
        files[f"p_{number}__csv"] = ("id,v\n" if header else "") + "".join(f"{number}{i},w\n" for i in range(n))
        total += n
    df, _files = scan_folder(spark, write(folder, **files), "csv", {}, ".csv")
    assert df.count() == total and df.columns == ["id", "v", "file_name"]


def test_corrupt_records(spark, tmp_path):
    base = write(tmp_path / "c", a__csv="1,2\nx,3\n4\n5,6,7\n")
    schema = StructType([StructField("id", IntegerType()), StructField("v", IntegerType())])
    df = scan_with_corrupt(spark, base, "csv", schema)
    assert rows(good_records(df)) == [(1, 2, "a.csv")]
    assert rows(corrupt_records(df)) == [("a.csv", "4"), ("a.csv", "5,6,7"), ("a.csv", "x,3")]
    assert good_records(df).select("v").count() == 1
    assert corrupt_records(df).select("_corrupt_record").count() == 3


def test_corrupt_json(spark, tmp_path):
    base = write(tmp_path / "j", a__json='{"id": 1, "v": 2}\n{"id": oops\n')
    schema = StructType([StructField("id", IntegerType()), StructField("v", IntegerType())])
    df = scan_with_corrupt(spark, base, "json", schema)
    assert rows(good_records(df)) == [(1, 2, "a.json")] and rows(corrupt_records(df)) == [("a.json", '{"id": oops')]


def test_fixed_width(spark, tmp_path):
    def record(text, zoned, packed, number):
        return text.ljust(10).encode("cp037") + zoned + packed + number.to_bytes(2, "big", signed=True)

    # Zoned: digits with zone F, the sign in the last zone. Packed: digit pairs, the sign in the last half byte.
    data = [
        record("Ünï [a]", b"\xf0\xf0\xf1\xc2", b"\x12\x34\x5c", 7),
        record("neg", b"\xf0\xf0\xf1\xd2", b"\x00\x01\x2d", -7),
        record("", b"\x40\x40\x40\x40", b"\x00\x00\x0f", 0),
    ]
    path = tmp_path / "a, b.dat"
    path.write_bytes(b"".join(data))
    layout = [Field("t", 0, 10), Field("z", 10, 4, "zoned"), Field("p", 14, 3, "packed", 2), Field("b", 17, 2, "binary")]
    df = scan_fixed_width(spark, [str(path)], layout)
    assert [(r.t, r.z, None if r.p is None else float(r.p), r.b, r.file_name) for r in df.collect()] == [
        ("Ünï [a]", 12, 123.45, 7, "a, b.dat"), ("neg", -12, -0.12, -7, "a, b.dat"), ("", None, 0.0, 0, "a, b.dat")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    with pytest.raises(ValueError):
        scan_fixed_width(spark, [str(path)], [])


def test_range_predicates_cover_every_value():
    assert range_predicates("k", [10, 20]) == ["k < 10 OR k IS NULL", "k >= 10 AND k < 20", "k >= 20"]
    assert range_predicates("d", ["o'x"]) == ["d < 'o''x' OR d IS NULL", "d >= 'o''x'"]
    assert range_predicates("k", []) == ["1 = 1"]


def test_table_scan_needs_a_name(spark):
    with pytest.raises(ValueError):
        scan_table(spark, "")


def test_other_formats(spark, tmp_path):
    base = write(tmp_path / "x", a__xml="<r><row><id>1</id></row><row><id>2</id></row></r>")
    assert rows(scan_folder(spark, base, "xml", {"rowTag": "row"}, ".xml")[0]) == [(1, "a.xml"), (2, "a.xml")]
    base = write(tmp_path / "t", a__txt="x\ny\n")
    assert rows(scan_folder(spark, base, "text")[0]) == [("x", "a.txt"), ("y", "a.txt")]
    assert scan_folder(spark, base, "binaryFile")[0].select("length", "file_name").first() == (4, "a.txt")
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.dat").write_bytes("ab12".encode("cp037"))
    layout = [Field("t", 0, 2), Field("n", 2, 2, "zoned")]
    assert rows(scan_folder(spark, str(tmp_path / "m"), "cobol", layout=layout)[0]) == [("ab", 12, "a.dat")]


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        scan_folder(spark, str(tmp_path), "pdf")

"""Quoted CSV by byte ranges: the same rows however the files are cut."""
import csv
import io
import os
import random

import pytest
from pyspark.sql import types as T

from firmo.sources import csv_ranges as CR
from firmo.sources import files as FI

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])


def put(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def test_states_of_lines():
    for line, start, end in ((b'a,b', False, False), (b'a,"b', False, True), (b'b",c', True, False), (b'it"s,b', False, False), (b'3,it"s "x" y', False, False),
                             (b'"a""', False, True), (b'""', True, True), (b'"', True, False), (b' "a","b" , "c', False, True), (b'', True, True), (b'x","y', True, True)):
        assert CR.ends_inside(line, start) == end, line
    assert CR.cells(b' x ,"y ""z"" ",, "",it"s', "-") == ["x", 'y "z" ', "-", "", 'it"s']


@pytest.mark.parametrize("range_bytes", [None, 150, 1000])
def test_ranges_give_the_same_rows(spark, tmpdir_path, range_bytes):
    rnd, want = random.Random(5), []
    for k in range(2):
        rows = [["".join(rnd.choice(['x', 'é', '"', ',', '\n', ' y', '\r\n', '""']) for _ in range(rnd.randint(0, 12))).strip() + f"#{k}.{i}", str(i), "z\n" * (40 if i == 30 else 0) + "e"]
                for i in range(60)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL if k else csv.QUOTE_MINIMAL).writerows([["A", " b", "c"], *rows])
        put(tmpdir_path, f"{k}.csv", out.getvalue())
        want += [(r[0], int(r[1]), r[2]) for r in rows]
    good, rejects, about = FI.scan_csv(spark, tmpdir_path, SCHEMA, range_bytes=range_bytes)
    assert sorted((r.a, r.b, r.c) for r in good.collect()) == sorted(want)
    assert rejects.count() == 0 and about.count() == 2


@pytest.mark.parametrize("range_bytes, broadcast", [(None, 100), (9, 100), (9, 0)])
def test_stray_and_open_quotes(spark, tmpdir_path, range_bytes, broadcast):
    text = 'a,b,c\n"two\nlines",1,x\nfirst,2,it"s\nsecond,zz,y\n\nthird,3,"a ""b"""\nlast,4,"Oslo\nnext,5,Bonn\nmore,6,Rome\n'
    put(tmpdir_path, "a.csv", text)
    put(tmpdir_path, "empty.csv", "")
    rows, about = CR.read_records(spark, tmpdir_path, lambda n: f"{tmpdir_path}/out/{n}", "", range_bytes=range_bytes, broadcast_ranges=broadcast)
    assert sorted((r["at"], r["cells"][0], r["open"]) for r in rows.collect()) == [
        (text.index('"two'), "two\nlines", False), (text.index("first"), "first", False), (text.index("second"), "second", False),
        (text.index("third"), "third", False), (text.index("last"), "last", True)]
    good, rejects, _ = FI.scan_csv(spark, tmpdir_path, SCHEMA, range_bytes=range_bytes)
    assert sorted((r.a, r.b, r.c) for r in good.collect()) == [("first", 2, 'it"s'), ("third", 3, 'a "b"'), ("two\nlines", 1, "x")]
    assert sorted((r.byte_offset, r.cause) for r in rejects.collect()) == [(text.index("second"), CR.BAD_FIELD), (text.index("last"), CR.OPEN_QUOTE)]


def test_one_file_uses_many_tasks(spark, tmpdir_path):
    put(tmpdir_path, "big.csv", "a,b,c\n" + '"x\ny",1,z\n' * 5000)
    rows, about = CR.read_records(spark, tmpdir_path, lambda n: f"{tmpdir_path}/out/{n}", "", range_bytes=4096)
    assert spark.read.parquet(f"{tmpdir_path}/out/csv-ranges").count() > 10
    assert rows.count() == 5000

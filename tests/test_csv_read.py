"""CSV files by their own header: order, missing columns, quotes, long and short rows."""

from __future__ import annotations

import csv
import random

import pytest

from caremarts.operators.contracts import ColumnRule, Contract
from caremarts.operators.prepare import dedup_keep_first, prepare_providers, split_union
from caremarts.operators.validate import validate
from caremarts.sources.csv import MALFORMED_COL, ends_inside, read_source


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_columns_by_name_not_by_place(spark, tmp_path):
    write(tmp_path, "T-1.csv", "Provider,PotentialFraud\nP1,Yes\n")
    write(tmp_path, "T-2.csv", "PotentialFraud,Provider\nNo,P2\n")
    write(tmp_path, "T-3.csv", "Provider\nP3\n")
    df = read_source(spark, str(tmp_path / "T-*.csv"))
    assert rows(df, "Provider", "PotentialFraud") == [("P1", "Yes"), ("P2", "No"), ("P3", None)]


def test_missing_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_source(spark, str(tmp_path / "none-*.csv"))


def test_quotes_and_line_ends_inside_cells(spark, tmp_path):
    write(tmp_path, "a.csv", 'a,b\n"x ""q"" y","one\ntwo, three"\nplain,NA\n')
    df = read_source(spark, str(tmp_path / "a.csv"))
    assert rows(df, "a", "b") == [("plain", None), ('x "q" y', "one\ntwo, three")]


def quoted_file(rnd, records, end):
    """A CSV text of cells with commas, doubled quotes, stray quotes and line ends of both kinds."""
    bits = ["a", "bc", ",", '"', "\n", "\r\n", " ", "é", "x,y\n", '5"', ""]
    lines = []
    for i in range(records):
        cells = ["".join(rnd.choices(bits, k=rnd.randrange(6))) for _ in range(2)]
        if i % 40 == 7:
            cells[0] = "long\n" * rnd.randrange(60)  # over several splits
        plain = lambda c: c and c[0] != '"' and not set(c) & set(",\n\r")  # noqa: E731  a stray quote may stand bare
        cells = [c if plain(c) and rnd.random() < 0.7 else '"' + c.replace('"', '""') + '"' for c in cells]
        lines.append(",".join([str(i), *cells]) + rnd.choice([end, end, end * 2]))
    return f"id,a,b{end}" + "".join(lines)


@pytest.mark.parametrize("seed, split", [(1, 64), (2, 200), (3, 1000), (4, 1 << 20)])
def test_quoted_files_are_split_between_tasks(spark, tmp_path, seed, split):
    rnd = random.Random(seed)
    want = []
    for k, end in enumerate(["\n", "\r\n", "\n"]):
        path = tmp_path / f"f{k}.csv"
        path.write_bytes(quoted_file(rnd, 150, end).encode())
        with path.open(newline="", encoding="utf-8") as f:
            want += [(f"file:{path}", int(r[0]), *r[1:]) for r in list(csv.reader(f))[1:] if r]
        if end == "\n":  # as one task reads a whole file
            assert csv_whole(spark, str(path)) == [r[1:] for r in want if r[0] == f"file:{path}"]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, str(split))
        df = read_source(spark, str(tmp_path / "*.csv"), na_tokens=("none such",))
        got = df.select("_source_file", "id", "a", "b", "_block_start", "_row").collect()
        tasks = df.rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    found = sorted((r[0], int(r[1]), r[2] or "", r[3] or "") for r in got)
    assert [x for x in zip(found, want) if x[0] != x[1]] == [] and len(found) == len(want)
    assert tasks > 5 or split > 100_000
    # places are in the files' order
    by_place = sorted(got, key=lambda r: (r[0], r[4], r[5]))
    assert [(r[0], int(r[1])) for r in by_place] == [r[:2] for r in want]


def csv_whole(spark, path):
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "lineSep": "\n"}
    df = spark.read.schema("id string, a string, b string").options(**options).csv(path)
    return sorted((int(r.id), r.a or "", r.b or "") for r in df.collect())


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("a,b", False, True),
        ('"a', True, False),
        ('a"b,c', False, False),
        ('a,"b ""c""', True, False),
        ('x"",y', False, True),
        ('x",y', False, False),
        ('x","y', True, True),
        ('"a"b",c', False, False),
        ('"a" "b,"c', True, True),
        ("", False, True),
    ],
)
def test_state_after_a_line(line, outside, inside):
    assert (ends_inside(line, False), ends_inside(line, True)) == (outside, inside)


def test_a_cell_that_is_never_closed_ends_with_its_file(spark, tmp_path):
    write(tmp_path, "a.csv", 'a,b\n1,2\n3,"open\n4,5\n')
    write(tmp_path, "b.csv", "a,b\n6,7\n")
    df = read_source(spark, str(tmp_path / "*.csv"))
    assert sorted(r.a for r in df.collect()) == ["1", "3", "6"]


def test_long_rows_are_rejected_and_short_ones_padded(spark, tmp_path):
    write(tmp_path, "a.csv", 'a,b\n1,2,3\n4\n"5,5",6\n')
    df = read_source(spark, str(tmp_path / "a.csv"))
    contract = Contract("t", "a", {"a": ColumnRule("str", unique=True), "b": ColumnRule("str", nullable=True)})
    v = validate(df, contract)
    assert rows(v.valid, "a", "b") == [("4", None), ("5,5", "6")]
    (bad,) = v.rejected.collect()
    assert bad["_reject_reasons"] == ["row:malformed"] and bad[MALFORMED_COL] == "1,2,3"


def test_keep_first_is_the_first_row_of_the_file(spark, tmp_path):
    train = write(tmp_path, "Train-1.csv", "Provider,PotentialFraud\nP1,Yes\nP1,No\nP2,No\nP2,Yes\n")
    test = write(tmp_path, "Test-1.csv", "Provider\nP1\nP9\n")
    df = prepare_providers(read_source(spark, train), read_source(spark, test))
    assert rows(df, "Provider", "PotentialFraud") == [("P1", "Yes"), ("P2", "No"), ("P9", None)]
    both = split_union(read_source(spark, test), read_source(spark, train))
    assert dict(rows(dedup_keep_first(both, "Provider"), "Provider", "PotentialFraud"))["P1"] is None


@pytest.mark.parametrize("cell, ok", [("12", True), ("12.0", True), ("12.5", False), ("twelve", False), ("-3.00", True), ("", False)])
def test_whole_numbers_may_carry_a_zero_fraction(spark, cell, ok):
    df = spark.createDataFrame([("k", cell)], "k string, n string")
    v = validate(df, Contract("t", "k", {"k": ColumnRule("str"), "n": ColumnRule("int")}))
    assert v.valid.count() == ok and v.rejected.count() == (not ok)
    if ok:
        assert v.valid.first()["n"] == int(float(cell))


def test_nothing_stays_cached(spark, tmp_path):
    df = spark.createDataFrame([("k", "1"), ("k", "2")], "k string, n string")
    v = validate(df, Contract("t", "k", {"k": ColumnRule("str", unique=True), "n": ColumnRule("int")}))
    assert v.rejected.count() == 2
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()

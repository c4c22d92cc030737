"""Records that span lines, in files of many splits, against Spark's parser of whole files."""

import random

import pyarrow as pa
import pytest

from scholarweave.sources import csv_records as C, tables
from scholarweave.workspace import scratch_path


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ["997", "1", "1"]):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def written(spark, text, name="csv"):
    folder = scratch_path(spark, name)
    spark.sparkContext._jvm.java.io.File(folder).mkdirs()
    with open(f"{folder}/a.csv", "w", newline="") as file:
        file.write(text)
    return f"{folder}/a.csv"


def whole(spark, path, schema=None):
    read = tables._csv(spark).option("multiLine", True)
    return (read.schema(schema) if schema else read.option("inferSchema", False)).csv(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def field(rng):
    kind = rng.randrange(9)
    words = "".join(rng.choices(["a", "é", " ", "7", "\U0001F600", "x,y"[0], "word"], k=rng.randrange(0, 9)))
    if kind < 4:
        return words
    if kind == 4:
        return words + 'b"c"d' if words.strip() else "z"  # a quote inside an unquoted field
    inner = "".join(rng.choices(["\n", ",", '""', "a", "line", "\n\n", " "], k=rng.randrange(0, 14 if kind < 8 else 200)))
    return f'"{inner}"'


@pytest.mark.parametrize("seed", range(4))
def test_random_files_against_the_parser_of_whole_files(spark, small_splits, seed):
    rng = random.Random(seed)
    lines = ["id,one,two"] + [f"{i},{field(rng)},{field(rng)}" for i in range(500)]
    lines[rng.randrange(1, 500)] = ""
    text = "\n".join(lines) + rng.choice(["", "\n"])
    path = written(spark, text)
    found = tables.read_csv_text(spark, path)
    assert found.columns == ["id", "one", "two"]
    assert found.rdd.getNumPartitions() > 10
    assert rows(found) == rows(whole(spark, path))
    schema = "id int, one string, two string"
    assert rows(tables.read_csv(spark, path, schema)) == rows(whole(spark, path, schema))


def test_line_ends_of_other_systems(spark, small_splits):
    rng = random.Random(9)
    lines = ["id,t"] + [f'{i},"{"line " * rng.randrange(9)}\r\nnext, ""q"" "' if i % 3 else f"{i},plain" for i in range(200)]
    path = written(spark, "\r\n".join(lines) + "\r\n")
    assert rows(tables.read_csv_text(spark, path)) == rows(whole(spark, path))


def test_records_longer_than_several_splits_and_a_long_header(spark, small_splits):
    long = "\n".join(f"line {i}, \"\"{i}\"\"" for i in range(300))
    text = f'id,"a\n{"long header " * 60}\nname"\n1,"{long}"\n2,x\n3,"{long}"\n'
    path = written(spark, text)
    found = tables.read_csv_text(spark, path)
    assert found.columns == whole(spark, path).columns
    assert rows(found) == rows(whole(spark, path)) and len(rows(found)) == 3


def test_several_files_with_headers_of_their_own(spark, small_splits):
    folder = scratch_path(spark, "groups")
    frame = spark.createDataFrame([(i, f"a\n{i}" * (i % 40)) for i in range(100)], "n long, text string").repartition(3)
    tables.write_csv(frame, f"{folder}/group1.csv")
    tables.write_csv(frame.selectExpr("text AS other", "n"), f"{folder}/group2.csv")
    first, second = tables.read_group_files(spark, f"{folder}/group*.csv")
    want = sorted((str(r.n), r.text or None) for r in frame.collect())
    assert sorted((r.n, r.text) for r in first.collect()) == want
    assert sorted((r.n, r.other) for r in second.collect()) == want
    assert tables.read_group_files(spark, f"{folder}/none*.csv") == []


def test_an_open_quote_is_an_error(spark):
    path = written(spark, 'id,t\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="a.csv"):
        tables.read_csv_text(spark, path)


def test_header_alone_and_empty_lines(spark):
    assert rows(tables.read_csv_text(spark, written(spark, "id,t\n"))) == []
    path = written(spark, "\n\nid,t\n\n1,x\n  \n\n")
    assert rows(tables.read_csv_text(spark, path)) == rows(whole(spark, path))


def test_effects_of_lines():
    cases = {
        "a,b": (False, True), 'a,"b': (True, False), '"a",b': (False, False), 'a"': (False, False), '","': (False, True),
        '"a""': (True, False), 'a"b,c': (False, False), '""': (False, True), '"': (True, False), 'x,""""': (False, True),
        '",a': (True, False), '"x" y,"z': (True, True), "": (False, True),
    }
    for line, (outside, inside) in cases.items():
        found = C.line_effects(pa.array([line.encode()]))
        assert found[0][0] == outside, line
        assert found[1][0] == inside, line
    assert C.states_after(*C.line_effects(pa.array([b'"', b"x", b'"', b'",a'])), False).tolist() == [True, True, False, True]

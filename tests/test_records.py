"""Parallel scan of delimited files: the rows of a reader that takes whole files."""

import csv
import random

import pytest

from quarry import sinks, sources
from quarry.sources import records


def whole_files(spark, path, columns, header):
    df = (spark.read.schema(sources.string_schema(columns)).option("quote", '"').option("escape", '"').option("multiLine", "true")
          .option("header", str(header).lower()).option("mode", "FAILFAST").csv(path))
    return sorted(tuple(r) for r in df.na.fill("", columns).collect())


def field(rng):
    text = "".join(rng.choice(["a", "é", '"', ",", "\n", "b c"]) for _ in range(rng.randrange(0, 7)))
    kind = rng.randrange(5)
    if kind == 0:
        return "".join(c for c in text if c not in '",\n') or "z"
    return 'm"id' if kind == 1 else '"' + text.replace('"', '""') + '"'


@pytest.fixture()
def split_bytes(spark):
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def put(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield put
    for k, v in kept.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("seed,line_break", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_records_at_every_border(spark, tmp_dir, split_bytes, seed, line_break):
    rng = random.Random(seed)
    for name in ("one file.csv", "two.csv"):
        rows = [",".join(field(rng).replace("\n", line_break) for _ in range(2)) for _ in range(25)]
        with open(f"{tmp_dir}/{name}", "w", newline="") as out:
            out.write(line_break.join(["h1,h2", *rows]) + (line_break if name == "two.csv" else ""))
    want = {h: whole_files(spark, tmp_dir, ["a", "b"], h) for h in (True, False)}
    for size in (5, 23, 64, 100_000):
        split_bytes(size)
        got = sources.scan_delimited(spark, tmp_dir, ["a", "b"], position="at").collect()
        assert sorted((r["a"], r["b"]) for r in got) == want[True]
        if line_break == "\n":  # in file order
            plain = [tuple(r) for name in ("one file.csv", "two.csv") for r in list(csv.reader(open(f"{tmp_dir}/{name}", newline="")))[1:] if r]
            assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: tuple(r["at"]))] == plain
    assert sorted(tuple(r) for r in sources.scan_delimited(spark, tmp_dir, ["a", "b"], header=False).collect()) == want[False]


def test_header_and_field_over_many_splits(spark, tmp_dir, split_bytes):
    split_bytes(16)
    body = "\n".join(f'line {i} ""quoted"", more' for i in range(60))
    with open(f"{tmp_dir}/long.csv", "w") as out:
        out.write(f'"head\nof two lines, and more than a split",b\n"{body}",x\n\n"last",y')
    got = sources.scan_delimited(spark, tmp_dir, ["a", "b"], position="at").orderBy("at").collect()
    assert [(r["a"], r["b"]) for r in got] == [(body.replace('""', '"'), "x"), ("last", "y")]
    with open(f"{tmp_dir}/long.csv") as text:
        assert records.ends_inside(text.readline().rstrip("\n"), False, ",")


def test_one_file_is_read_by_many_tasks(spark, tmp_dir, split_bytes):
    df = spark.range(4000).selectExpr("cast(id as string) a", "concat('x', repeat(concat('\\n', id, '\"'), 5)) b")
    sinks.write_delimited(df.coalesce(1), tmp_dir + "/big", header=True)
    split_bytes(20_000)
    got = sources.scan_delimited(spark, tmp_dir + "/big", ["a", "b"])
    assert got.rdd.getNumPartitions() > 6
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in df.collect())


def test_ends_inside_against_a_plain_automaton():
    def plain(line, inside, sep):
        state = "quoted" if inside else "begin"
        for i, c in enumerate(line):
            if state == "begin":
                state = "quoted" if c == '"' else "begin" if c == sep else "plain"
            elif state == "plain":
                state = "begin" if c == sep else "plain"
            elif state == "quoted":
                state = "quote" if c == '"' else "quoted"
            else:
                state = "quoted" if c == '"' else "begin" if c == sep else "plain"
        return state == "quoted"
    rng = random.Random(9)
    for _ in range(4000):
        line = "".join(rng.choice('",a') for _ in range(rng.randrange(0, 10)))
        for inside in (False, True):
            assert records.ends_inside(line, inside, ",") == plain(line, inside, ","), (line, inside)

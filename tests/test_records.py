"""Splittable CSV: the rows of the whole-file parser, whatever the splits cut."""

import random
import tempfile

import pytest

from reelhouse.sources import files, records

SIZE, COST = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@pytest.fixture
def split_bytes(spark):
    def use(n):
        spark.conf.set(SIZE, str(n))
        spark.conf.set(COST, "0")

    yield use
    spark.conf.unset(SIZE)
    spark.conf.unset(COST)


def folder(texts):
    d = tempfile.mkdtemp(prefix="reelhouse-records-", dir="/tmp")
    for i, t in enumerate(texts):
        with open(f"{d}/part-{i}.csv", "w", newline="") as fh:
            fh.write(t)
    return d


def same_rows(spark, path):
    whole = files.read_films_csv(spark, path, multi_line=True)
    got = records.read_csv_records(spark, path)
    assert got.columns == whole.columns
    key = lambda r: tuple("" if x is None else f"v{x}" for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key)
    return got


def cell(r, breaks):
    text = "".join(r.choice(['a', 'bc', ' ', '""', ',', "'", 'é', '\\', "x" * 30] + breaks) for _ in range(r.randint(0, 9)))
    return r.choice([f'"{text}"', f'"{text}"', str(r.randint(0, 999)), "", "plain", 'in"ner', 'two""q', 'five"'])


@pytest.mark.parametrize("seed,eol,breaks", [(1, "\n", ["\n"]), (2, "\n", ["\n", "\n\n", '""\n,']), (3, "\r\n", ["\r\n", "\n"]), (4, "\n", [])])
def test_equals_the_whole_file_parser(spark, split_bytes, seed, eol, breaks):
    r = random.Random(seed)
    texts = []
    for _ in range(2):
        rows = [f"tt{i}," + ",".join(cell(r, breaks) for _ in range(3)) + f",end{i}" for i in range(r.randint(60, 120))]
        texts.append(eol.join(["id,a,b,c,last", *rows]) + r.choice(["", eol]))
    path = folder(texts)
    for n in (10**6, 700, 97):
        split_bytes(n)
        same_rows(spark, path)


def test_a_record_over_many_splits(spark, split_bytes):
    long = "\n".join(f'line {i}, ""q""' for i in range(400))
    path = folder([f'id,text,n\n1,"{long}",x\n2,plain,y\n3,"{long}"\n4,z,"w\n"\n5,"a\nb",c\n'])
    split_bytes(250)
    got = same_rows(spark, path)
    assert records.text_lines(spark, path).rdd.getNumPartitions() >= 4
    rows = {r.id: r for r in got.collect()}
    assert rows["1"].text.count("\n") == 399 and rows["1"].n == "x" and rows["5"].text == "a\nb"


def test_blank_lines_and_short_files(spark, split_bytes):
    split_bytes(40)
    same_rows(spark, folder(['\n\nid,t\n1,"a\n\n\nb"\n\n\n2,c\n']))
    same_rows(spark, folder(['"id","t\nwo"\n1,"a\nb"\n']))
    same_rows(spark, folder(["id,t\n", 'id,t\n1,"a\nb"\n']))
    assert records.read_csv_records(spark, folder(["id,t\n"])).count() == 0


def test_lines_of_plain_splits_do_not_move(spark, split_bytes):
    body = "".join(f"{i},plain text\n" for i in range(3000))
    split_bytes(4000)
    path = folder([f'id,t\n{body}x,"two\nlines"\n{body}'])
    lines = records.text_lines(spark, path)
    mixed = records.split_table(lines).filter("mixed").count()
    assert 1 <= mixed <= 2 and lines.rdd.getNumPartitions() > 10
    same_rows(spark, path)
    plain = records.read_csv_records(spark, folder([f"id,t\n{body}"]))
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()


def test_a_file_that_ends_inside_quotes_raises(spark):
    path = folder(['id,t\n1,a\n2,"open\n3,b\n'])
    with pytest.raises(records.OpenQuoteError, match="part-0.csv"):
        files.read_films_csv(spark, path)
    kept = records.read_csv_records(spark, path, unclosed="keep").collect()
    assert [r.id for r in kept] == ["1", "2"] and kept[1].t.rstrip("\n") == "open\n3,b"

"""JSON arrays of any layout, cut at every place."""

import json

import pytest
from postlens import sources
from postlens.sources import arrays

from conftest import posting, rows_of

AWKWARD = ['x}y{', '"', '\\', '\\"}', '{"a":"}"}', '][', "é漢👩", "", "\n}\t", "}}}{{{", '\\\\"', "]}"]


def objects(n):
    return [{"job_id": str(i), "job_title": AWKWARD[i % len(AWKWARD)], "skills": ["}", AWKWARD[-i % 7]], "salary": i} for i in range(n)]


LAYOUTS = {
    "compact": lambda x: json.dumps(x, separators=(",", ":"), ensure_ascii=False),
    "two": lambda x: json.dumps(x, indent=2),
    "seven": lambda x: json.dumps(x, indent=7, ensure_ascii=False),
    "crlf": lambda x: "  \r\n" + json.dumps(x, indent="\t").replace("\n", "\r\n") + "\r\n  ",
    "lines": lambda x: "[" + "\n,".join(map(json.dumps, x)) + "\n]\n",
    "nested": lambda x: json.dumps([{**o, "more": {"deep": [{"x": {}}, "{", {"y": "}"}]}} for o in x]),
}


@pytest.fixture
def ranges(spark):
    """Sets the size of the ranges that files are read by."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")

    def of(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
        spark.conf.set(names[2], "1")

    yield of
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_every_layout_in_ranges_of_any_size(spark, tmp_path, ranges, layout):
    want = objects(60)
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(LAYOUTS[layout](want[i * 20 : i * 20 + 20]), newline="")
    for size in (37, 173, 10_000_000):
        ranges(size)
        got = [json.loads(r[0]) for r in sources.array_records(spark, str(tmp_path)).collect()]
        for x in got:
            x.pop("more", None)
        assert sorted(got, key=lambda x: int(x["job_id"])) == want


def test_odd_files(spark, tmp_path, ranges):
    texts = {"empty": "", "none": "[]", "blank": " \n[ ]\n", "one": '{"a":1}', "plain": '[1, "a{b}", null, {"a": 2}, "c}", [], {"a": 3}]'}
    texts |= {"cut": '[{"a": 4}, {"a": {"b": "x', "long": json.dumps([{"a": "y" * 5000}, {"a": 5}])}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    for size in (11, 64, 100_000):
        ranges(size)
        got = sorted(r[0] for r in sources.array_records(spark, str(tmp_path)).collect())
        whole = sorted(['{"a":1}', '{"a": 2}', '{"a": 3}', '{"a": 4}', '{"a": 5}', json.dumps({"a": "y" * 5000})])
        assert sorted(x for x in got if not x.startswith('{"a": {"b"')) == whole and len(got) == len(whole) + 1
    with pytest.raises(ValueError, match="ranges"):
        sources.array_records(spark, str(tmp_path), max_ranges=3)


def test_postings_equal_the_reader_of_one_task(spark, postings, tmp_path, ranges):
    rows = [posting(str(i), job_title=AWKWARD[i % len(AWKWARD)], skills=["a}", "{b"] if i % 3 else None) for i in range(50)]
    text = "[" + ", ".join(r[0] for r in postings(*rows).toJSON().map(lambda x: (x,)).collect()) + "]"
    (tmp_path / "p.json").write_text(text)
    ranges(300)
    one = sources.read_postings(spark, str(tmp_path), indent=None)
    many = sources.read_postings(spark, str(tmp_path), indent="any")
    assert many.schema == one.schema and sorted(map(str, rows_of(many))) == sorted(map(str, rows_of(one))) and many.count() == 50
    assert sources.read_postings(spark, str(tmp_path), indent="any", keep_corrupt=True).filter("_corrupt_record is not null").count() == 0


def test_effect_of_a_piece():
    assert arrays._effect("{") == ((0, 0), (1, 0))
    assert arrays._effect('{"a":"x') == ((1, 1), (0, -1))
    assert arrays._effect('{"a":"\\\\"') == ((0, 0), (1, 0))
    assert arrays._effect('y","b":{"c":1') == ((1, 0), (0, 0))

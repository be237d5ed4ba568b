"""Pieces of JSON arrays scanned a batch at a time, wherever batches and ranges end."""

import json
import random
from types import SimpleNamespace

import pyarrow as pa
from postlens import sources
from postlens.sources import arrays

AWKWARD = ['x}y{', '"', "\\", '\\"}', '{"a":"}"}', "é漢👩{", "", "\\\\}", "}}}{{{", '\\\\"', "]}"]


def batches(text, ranges, rows):
    """(value, file, start) as Spark hands them over: ranges of ``ranges`` pieces, batches of ``rows``."""
    pieces = text.split("}")
    pieces = pieces if pieces[-1] else pieces[:-1]
    table = [(x, "f", i // ranges * 10) for i, x in enumerate(pieces)]
    for i in range(0, len(table), rows):
        columns = list(zip(*table[i : i + rows]))
        kinds = (pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["value", "file", "start"])


def records(text, ranges, rows):
    found = pa.Table.from_batches(arrays._scanned(batches(text, ranges, rows)))
    begins = arrays._folded(found).to_pylist()
    states = SimpleNamespace(value={(r["file"], r["start"]): (r["inside"], r["depth"], r["origin"]) for r in begins})
    whole = [x for b in arrays._cut(states, False)(batches(text, ranges, rows)) for x in b.column(0).to_pylist()]
    parts: dict[int, str] = {}
    for b in arrays._cut(states, True)(batches(text, ranges, rows)):
        for r in b.to_pylist():
            parts[r["origin"]] = parts.get(r["origin"], "") + r["record"]
    crosses = any(r["depth"] > 0 or r["left"] > 0 for r in begins)
    assert crosses or not parts
    return whole + list(parts.values())


def test_records_in_batches_and_ranges_of_any_size():
    chance = random.Random(1)
    for n in range(60):
        word = lambda: chance.choice(AWKWARD) + chance.choice(AWKWARD)
        want = [{"n": i, word(): [word(), {"d": {word(): word()}}], "e": {}} for i in range(n % 7)]
        text = json.dumps(want, indent=n % 3 or None, ensure_ascii=n % 2 == 0)
        for ranges, rows in ((1, 1), (2, 3), (5, 2), (4, 1000), (1000, 3), (1000, 1000)):
            got = [json.loads(x) for x in records(text, ranges, rows)]
            assert sorted(got, key=lambda x: x["n"]) == want, (n, ranges, rows)


def test_no_third_scan_where_no_record_crosses_ranges(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps([{"a": "}"}, {"b": 1}]))
    got = sources.array_records(spark, str(tmp_path))
    assert got.count() == 6
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    (tmp_path / "cut.json").write_text('[{"a": 1}, {"c": {"b": "x')
    assert sources.array_records(spark, str(tmp_path)).count() == 8

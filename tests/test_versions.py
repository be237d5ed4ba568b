"""Sets of results appear whole or not at all."""

import json
import threading

import pytest
from postlens import plans, sources
from postlens.plans import market

from conftest import posting, rows_of


def names(n):
    return [posting(str(i), job_title=f"t{n}", industry=f"i{i % 3}", salary=1000.0 * n) for i in range(n)]


def state(spark, folder):
    """(postings in all, by industry, titles) of what a reader gets."""
    bundle = sources.insights(spark, folder)
    total = rows_of(bundle["overall_stats"])[0][0]
    return total, sum(r[1] for r in rows_of(bundle["industry_metrics"])), {r[0] for r in rows_of(bundle["salary_by_title_exp"])}


def test_an_interrupted_run_is_never_seen(spark, postings, tmp_path, monkeypatch):
    out = str(tmp_path / "m")
    plans.record_market(postings(*names(4)), out)
    assert state(spark, out) == (4, 4, {"t4"})
    written = []
    plain = market.write_result

    def breaks(df, path, fmt="json"):
        written.append(path)
        if len(written) == 4:
            raise OSError("disk is full")
        plain(df, path, fmt)

    monkeypatch.setattr(market, "write_result", breaks)
    with pytest.raises(OSError):
        plans.record_market(postings(*names(9)), out)
    assert len(written) == 4 and state(spark, out) == (4, 4, {"t4"})
    monkeypatch.setattr(market, "write_result", plain)
    plans.record_market(postings(*names(6)), out)
    assert state(spark, out) == (6, 6, {"t6"})


def test_readers_never_see_a_mixture(spark, postings, tmp_path):
    out = str(tmp_path / "m")
    plans.record_market(postings(*names(1)), out)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(state(spark, out))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (2, 3, 4):
            plans.record_market(postings(*names(n)), out)
    finally:
        stop.set()
        reader.join()
    assert seen and all(total == parts and titles == {f"t{total}"} for total, parts, titles in seen)
    assert [x[0] for x in seen] == sorted(x[0] for x in seen)
    assert state(spark, out)[0] == 4


def test_rival_writers_get_versions_of_their_own(spark, tmp_path):
    folder = str(tmp_path / "v")
    assert sources.current_version(spark, folder) == folder

    def write(n):
        def body(path):
            spark.range(n).write.parquet(f"{path}/t")

        return lambda: sources.publish(spark, folder, body)

    rivals = [threading.Thread(target=write(n)) for n in range(1, 6)]
    for x in rivals:
        x.start()
    for x in rivals:
        x.join()
    listed = sorted((tmp_path / "v" / "_versions").glob("[0-9]*.json"))
    assert [x.name for x in listed] == [f"{i:012d}.json" for i in range(1, 6)]
    assert len({json.loads(x.read_text())["set"] for x in listed}) == 5
    last = sources.publish(spark, folder, lambda path: spark.range(77).write.parquet(f"{path}/t"))
    assert sources.current_version(spark, folder) == last
    assert sources.remove_old_versions(spark, folder, keep=1) == 5
    assert spark.read.parquet(f"{sources.current_version(spark, folder)}/t").count() == 77
    assert len(list((tmp_path / "v" / "_sets").iterdir())) == 1
    with pytest.raises(ValueError, match="keep"):
        sources.remove_old_versions(spark, folder, keep=0)


def test_a_failing_body_lists_nothing(spark, tmp_path):
    folder = str(tmp_path / "v")
    with pytest.raises(RuntimeError):
        with sources.new_version(spark, folder) as path:
            spark.range(3).write.parquet(f"{path}/t")
            raise RuntimeError
    assert sources.current_version(spark, folder) == folder

"""JSON records over split files: every layout and mix, quotes and braces at borders, broken records."""

import gzip
import json
import random

import pytest

from tidemark.sources import json_records, readers


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "37b")
    spark.conf.set(names[1], "1b")
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def values(df, column="a"):
    return sorted(r[column] for r in df.collect())


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.json").write_text(text)
    return str(folder)


def test_one_file_mixes_lines_and_spread_records(spark, tmp_path):
    path = put(tmp_path / "d", f='{"a":1}\n{\n "a":2\n}\n{"a":3}')
    assert values(readers.read_json_records(spark, path)) == [1, 2, 3]


def test_an_array_file_beside_a_line_file(spark, tmp_path):
    path = put(tmp_path / "d", f='[{"a":1},{"a":2}]', g='{"a":3}\n{"a":4}\n')
    assert values(readers.read_json_records(spark, path)) == [1, 2, 3, 4]
    path = put(tmp_path / "e", f='{"a":3}\n{"a":4}\n{"a":5}', g='[\n{"a":1},\n{"a":2}\n]')
    assert values(readers.read_json_records(spark, path)) == [1, 2, 3, 4, 5]


def test_a_line_file_beside_a_spread_file(spark, tmp_path):
    lines = "\n".join(json.dumps({"a": k}) for k in range(5))
    spread = "\n".join(json.dumps({"a": k}, indent=2) for k in (5, 6))
    for k, (f, g) in enumerate([(lines, spread), (spread, lines)]):
        path = put(tmp_path / f"d{k}", f=f, g=g)
        assert values(readers.read_any(spark, path)) == list(range(7))


TRICKY = ['a{b', "}", 'x"y', "\\", '{"q":1}', "line\nbreak", "é}", "", "]["]


def tricky(state, depth=0):
    kind = state.randrange(6)
    if kind == 0 and depth < 3:
        return {c: tricky(state, depth + 1) for c in state.sample("xyz", state.randrange(3))}
    if kind == 1 and depth < 3:
        return [tricky(state, depth + 1) for _ in range(state.randrange(3))]
    return state.choice(TRICKY) if kind < 4 else state.choice([None, True, 1.5])


def text_of(state, records):
    layout, indent = state.randrange(5), state.choice([None, 0, 1, 2])
    if layout == 0:
        return json.dumps(records, indent=indent)
    gap = {1: "\n", 2: ",\n", 3: "", 4: "\n\n"}[layout]
    return gap.join(json.dumps(r, indent=indent if layout != 1 else None, ensure_ascii=layout == 2) for r in records)


def test_random_files_in_many_splits(spark, tmp_path, small_splits):
    state, want, files = random.Random(3), [], {}
    for f in range(12):
        records = [{"a": 1000 * f + k, "v": tricky(state)} for k in range(state.randrange(1, 12))]
        want += records
        cut = state.randrange(len(records) + 1)
        files[f"f{f}"] = "\n".join(text_of(state, part) for part in (records[:cut], records[cut:]) if part)
    path = put(tmp_path / "d", **files)
    assert json_records._pieces(spark, path).rdd.getNumPartitions() >= 30
    got = [json.loads(r.value) for r in spark.read.text(json_records.to_lines(spark, path)).collect()]
    assert sorted(got, key=lambda r: r["a"]) == want


def test_one_long_line_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = put(tmp_path / "d", f=json.dumps([{"a": k, "s": "}{" * (k % 5)} for k in range(300)]))
    assert values(readers.read_json_records(spark, path, "a int")) == list(range(300))


def test_states_may_come_by_a_shuffle(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(json_records, "BROADCAST_SPLITS", 0)
    path = put(tmp_path / "d", f=json.dumps([{"a": k, "s": {"t": ["}" * (k % 3)]}} for k in range(100)], indent=1))
    assert values(readers.read_json_records(spark, path, "a int")) == list(range(100))


@pytest.mark.parametrize("splits", ["whole", "small"])
def test_records_that_never_end(spark, tmp_path, splits, request):
    if splits == "small":
        request.getfixturevalue("small_splits")
    text = '{"a":1}\n{"a": {"b": 2\n{"a":3}\n{"a":4},\n  {"a":5}\n{"a":6, "s":"quite a long line, longer than one split"}\n'
    path = put(tmp_path / "d", f=text, g='{"a":10}\n{"a":11', h='}{"a":12}}\n{"a":13}')
    got = values(readers.read_json_records(spark, path, "a int"))
    assert got == [1, 3, 4, 6, 10, 12, 13]


def test_an_open_quote_ends_with_its_line(spark, tmp_path):
    path = put(tmp_path / "d", f='{"a": 1},\n{"a": "broken},\n{"a": 3},\n{"a": 4}\n')
    assert values(readers.read_json_records(spark, path, "a int")) == [1, 3, 4]


def test_packed_and_marked_files(spark, tmp_path):
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "f.json.gz").write_bytes(gzip.compress(b'[{"a":1},\n{"a":2}]\n'))
    (folder / "g.json").write_bytes('﻿{"a":3}'.encode())
    assert values(readers.read_json_records(spark, str(folder), "a int")) == [1, 2, 3]


def test_nothing_to_read(spark, tmp_path):
    for k, text in enumerate(["", "\n\n", "[]", "[1, 2]", '{"a": 1', "}}}"]):
        assert readers.read_json_records(spark, put(tmp_path / f"d{k}", f=text), "a int").count() == 0
    with pytest.raises(readers.NoData):
        readers.read_any(spark, str(put(tmp_path / "e", f='{"a": 1')) + "/f.json")


def test_splits_that_change_are_an_error():
    with pytest.raises(ValueError):
        json_records._Walk(("f", 0, None, None, None, None, None, None), print)

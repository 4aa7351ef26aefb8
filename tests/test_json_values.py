"""JSON files of many ranges against a reader that decodes value after value."""

import json
import random

import pytest

from promolens.sources import json_values as J
from promolens.sources import lists
from promolens.sources.tables import json_values, venues

HAND = [
    b'\xef\xbb\xbf[{"a": 1}, 2] {"a": 2}\n{"a": 3} oops {"a": 4}', b"", b"  ", b"[]", b"{}", b"[{}]", b'{"a": "}{][\\"}"}{"b": [{"c": {}}]}', b'[{"a": 1}, [{"x": 1}], {"b": 2}]', b'[{"a": 1} {"b": 2}] {"c": 3}',
    b'{"a": 1}, {"b": 2}', b'[{"a": 1}, {"b": 2}', b'[{"a": 1}, {"b": ]} {"c": 1}', b'{"z": 0} [{"a": 1}, {"b": 2},] {"c": 1}', b'{"a": 1}} {"b": 2}', b'{"a": 1', b'{"a": 1}\n5 "x}" null [3, {"k": "\\\\"}] {"b": "\\u00e9"}',
    '{"a": "é ü"} {"b": 2}'.encode(), b'{"a": "\xff"} {"b": 1}', b'[{"a": 1}] ] [{"b": 1}]', b'[1, 2, [{"a": 1}]] {"b": 2}', b'"un', b'{"a": 1}  ', b'[[{"a": 1}], {"b": [1, 2, 3]}, {"c": 1}, {"d" 1}]',
]


def written(tmp_path, files):
    for k, raw in enumerate(files):
        (tmp_path / f"f{k:03}.json").write_bytes(raw)
    return [x for raw in files for x in json_values(raw)]


def read(spark, path):
    return [json.loads(x.value) for x in sorted(J.objects(spark, str(path)).collect(), key=lambda x: x.row_idx)]


def any_json(r, depth=0):
    kind = r.randrange(7 if depth < 4 else 4)
    if kind < 4:
        return r.choice([1, None, True, "", "}{", '"]\\', "é" * r.randint(0, 30), 2.5])
    if kind == 4:
        return [any_json(r, depth + 1) for _ in range(r.randint(0, 4))]
    return {r.choice(["a", "}", "[", '"']) + str(i): any_json(r, depth + 1) for i in range(r.randint(0, 5))}


@pytest.fixture
def tiny_ranges(spark):
    def put(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield put
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(k)


@pytest.mark.parametrize("size", ["41", "128m"])
def test_hand_made_files(spark, tmp_path, tiny_ranges, size):
    tiny_ranges(size)
    want = written(tmp_path, HAND)
    assert read(spark, tmp_path) == want and len(want) > 15


def test_random_files_in_many_ranges(spark, tmp_path, tiny_ranges, monkeypatch):
    r, files = random.Random(9), []
    for k in range(5):
        values = [{"id": i, "v": any_json(r)} for i in range(r.randint(1, 12))]
        raw = json.dumps(values, indent=r.choice([None, 2]), ensure_ascii=False) if k % 2 else "".join(json.dumps(v) + r.choice(["", "\n", " "]) for v in values)
        raw = raw.encode()
        if k == 3:  # broken somewhere
            at = r.randrange(len(raw))
            raw = raw[:at] + r.choice([b"", b"}", b'"', b"]", b"{"]) + raw[at + 1 :]
        files.append(raw)
    want = written(tmp_path, files)
    tiny_ranges("300")
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 5
    assert read(spark, tmp_path) == want
    monkeypatch.setattr(J, "FEW", 0)  # what is known of ranges meets them in a shuffle
    assert read(spark, tmp_path) == want


def test_pieces_of_any_cut():
    """However a text is cut, sums of its pieces compose to the state that a reader of the whole has."""
    r = random.Random(2)
    for _ in range(300):
        text = json.dumps([any_json(r) for _ in range(3)])
        cuts = sorted(r.randrange(len(text) + 1) for _ in range(3))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        if any(p.endswith("\\") for p in pieces):  # a brace ends a range, so no escape does
            continue
        stack, in_string = "", False
        for p in pieces:
            stack, in_string = J.after(stack, in_string, J.summary(p, False), J.summary(p, True))
        assert (stack, in_string) == ("", False)


def test_venues(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"Source URL": "u1", "x": 1}, {"Source URL": "", "x": 2}]')
    (tmp_path / "b.json").write_text('{"Source URL": "u3", "x": {"y": [1]}}{"Source URL": "u4"} bad')
    got = sorted(tuple(x) for x in venues(spark, str(tmp_path), ["Source URL", "x"]).collect())
    assert got == [(0, "u1", "1"), (2, "u3", '{"y": [1]}'), (3, "u4", None)]


def test_record_files(spark, tmp_path):
    """Files that are not whole come back as rows with a reason; the others' records are read."""
    (tmp_path / "a.json").write_text('[{"x": 1, "m": {"y": "u"}}, {"x": 2}]')
    (tmp_path / "b.json").write_text('[{"x": 3}, {"x": 4')
    (tmp_path / "c_relabeled.json").write_text('{"x": 5}\n{"x": 6}\n')
    (tmp_path / "d.json").write_text('{"x": 7} oops')
    (tmp_path / "e.json").write_text("")
    path = str(tmp_path)
    assert sorted(r.x for r in lists.records(spark, path, schema="x long, m struct<y:string>").collect()) == [1, 2, 5, 6]
    assert sorted(r.x for r in lists.records(spark, f"{path}/a.json", f"{path}/c_relabeled.json", relabelled=False).collect()) == [1, 2]
    got = {r.path.rpartition("/")[2]: (r.block, r.reason) for r in lists.quarantined(spark, path).collect()}
    assert got.keys() == {"b.json", "d.json"} and got["d.json"] == (0, "no JSON between values: oops") and "char" in got["b.json"][1]
    assert lists.quarantined(spark, f"{path}/a.json").count() == 0

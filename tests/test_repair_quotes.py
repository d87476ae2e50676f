"""Repair of quotes inside values, and of faults far from the end."""

import json

import pytest

from recordloom.operators import answers as J


@pytest.mark.parametrize("text, expected", [
    ('{"corpus": "15B tokens", ~10% Python code)", "license": "MIT", "optimizer": "Adam"}', {"corpus": '15B tokens", ~10% Python code)', "license": "MIT", "optimizer": "Adam"}),
    ('{"innovation": "the "best" model", "license": "MIT"}', {"innovation": 'the "best" model', "license": "MIT"}),
    ('{"innovation": "a "b" and "c" d", "n": [1, 2], "license": "MIT"}', {"innovation": 'a "b" and "c" d', "n": [1, 2], "license": "MIT"}),
    ('{"a": "x "y" z", "b": 1, "c": "cut he', {"a": 'x "y" z', "b": 1, "c": "cut he"}),
    ('{"a": "x, "b": 2}', None),
])
def test_quotes_inside_values(text, expected):
    got = J.repair(text)
    assert got is not None
    if expected is not None:
        assert json.loads(got) == expected


def test_later_records_are_kept():
    many = [{"model_name": f"M{k}", "license": "MIT"} for k in range(40)]
    text = json.dumps({"extraction_data": [{"model_name": "A", "innovation": "the XbestX model"}, *many]}).replace("X", '"')
    assert len(json.loads(J.repair(text))["extraction_data"]) == 41


def test_every_comma_is_tried():
    text = '{"a": 1, "b": <' + ", <" * 80 + "}"
    assert json.loads(J.repair(text))["a"] == 1

"""Answers in their standard form: keys and null words at every depth, bare models, defaults."""

import json

import pytest

from recordloom.operators import answers as J


def form(d):
    return json.loads(J.standard(json.dumps(d)))


def test_bare_model_is_wrapped_and_completed():
    got = form({"Model Name": 1, "modelname": "Foo-7B-chat", "params": "1,300", "Licence": "None", "details": {"ORG": "n/a", "list": [{"hw_used": " NULL "}, "null", 3]}})
    (m,) = got["models"]
    assert got["paper_describes_multiple_models"] is False
    assert (m["model_name"], m["model_family"], m["parameters"], m["parameters_millions"], m["license"]) == ("Foo-7B-chat", "Foo", "1,300", 1300, None)
    assert m["Model Name"] == 1 and m["details"] == {"organization": None, "list": [{"hardware_used": None}, None, 3]} and "innovation" in m


def test_lists_flags_and_sizes():
    got = form({"Models": [{"name": "A", "parameters": "7B"}, {"name": None, "parameters": "large", "parameters_millions": 0}, "x"], "other": 1})
    assert [m["parameters_millions"] for m in got["models"]] == [7000, None] and got["models"][1]["model_family"] is None
    assert got["paper_describes_multiple_models"] is True and got["other"] == 1
    assert form({"models": [{"model_family": "F", "name": "A-1"}], "paper_describes_multiple_models": True}) ["paper_describes_multiple_models"] is True


@pytest.mark.parametrize("text", [None, "", "[1]", "no", "3"])
def test_no_object(text):
    assert J.standard(text) is None


def test_nothing_to_wrap():
    assert form({"x": 1}) == {"x": 1, "models": [], "paper_describes_multiple_models": False}

import json

import pytest

from assay.functions.thresholds import ConfigError
from assay.operators.schema import load_declared_schema
from assay.plans.catalogue import load_config
from assay.plans.expression_checks import run_expression_checks
from assay.sources.hocon import loads


@pytest.mark.parametrize("text, want", [
    ('{"a": [1, 2.5, true, null, "x"], "b": {"c": -1e3}}', {"a": [1, 2.5, True, None, "x"], "b": {"c": -1000.0}}),
    ("a = 1\nb : two words \n c { d = true }", {"a": 1, "b": "two words", "c": {"d": True}}),
    ("# top\na.b.c = 1 // end\na.b.d = \"1\"\n", {"a": {"b": {"c": 1, "d": "1"}}}),
    ("a = [1, 2\n 3\n]\na += 4", {"a": [1, 2, 3, 4]}),
    ("b += x", {"b": ["x"]}),
    ("a { x = 1 }\na { y = 2 }\na.x = 3", {"a": {"x": 3, "y": 2}}),
    ("base { t = 5, u = v }\nown = ${base} { t = 6 }\nn = ${base.t}", {"base": {"t": 5, "u": "v"}, "own": {"t": 6, "u": "v"}, "n": 5}),
    ("p = /data\nq = ${p}/in \nr = ${?none}\ns = [${?none}, 1]", {"p": "/data", "q": "/data/in", "s": [1]}),
    ('t = """two\n"lines\\""""', {"t": 'two\n"lines\\"'}),
    ('"a.b" = 1, c = "true", d = 1x, e = 007', {"a.b": 1, "c": "true", "d": "1x", "e": "007"}),
    ("a = [1] [2, 3]\nb = x${a0}y\na0 = 5", {"a": [1, 2, 3], "b": "x5y", "a0": 5}),
    ('a = "he said" ok', {"a": "he said ok"}), ("", {}), ("[1, {a = 2}]", [1, {"a": 2}]), ("{a=1,}", {"a": 1}),
    ("a = null\nb = []\nc = {}", {"a": None, "b": [], "c": {}}), ("kéy = été", {"kéy": "été"}), ("a = 'single'", {"a": "'single'"}),
])
def test_values(text, want):
    assert loads(text) == want


@pytest.mark.parametrize("text", ["a = ", "a 1", "{a = 1", "[1, 2", "a = 1}", "a = ${none}", "a = ${b}\nb = ${a}", "include file", "a = [1] x", "= 1", "a = b$c"])
def test_what_cannot_be_read_is_an_error(text):
    with pytest.raises(ConfigError):
        loads(text)


def test_any_json_is_read_as_json():
    value = {"a": ["x, y = z # no comment", {"b.c": "${no}"}], "d": "  \\ \""}
    assert loads(json.dumps(value)) == value == loads(json.dumps(value, indent=3))


def test_sidecar_and_config_files(frame, tmp_path):
    (tmp_path / "schema.conf").write_text("schema = [  # the columns\n  { columnName = x, columnType = Int }\n  { columnName = t, columnType = String }\n]\n")
    (tmp_path / "checks.conf").write_text("""
        all = [any]
        metrics = [ { metricName = nulls, definitionName = count nulls, metricType = Column, types = ${all} } ]
        checks = [ { checkName = "nulls of ${column}", expression = "nulls_${column}", operator = "=", threshold = 0, types = ${all} } ]
    """)
    types = load_declared_schema(str(tmp_path / "schema.conf"))
    assert types == [{"columnName": "x", "columnType": "Int"}, {"columnName": "t", "columnType": "String"}]
    rows = run_expression_checks(frame([("1", None), (None, None)], "x string, t string"), load_config(str(tmp_path / "checks.conf")), types=types).collect()
    assert {r.checkName: r.value for r in rows} == {"nulls of x": 1.0, "nulls of t": 2.0}

import os

import pytest

from tidemart.sources import tables as S
from tidemart.sources.statements import parameters, split_statements


@pytest.mark.parametrize("text,expected", [
    ("", []), (" ;; \n;", []), ("SELECT 1", ["SELECT 1"]), ("SELECT 1;", ["SELECT 1"]),
    ("a;b ; c", ["a", "b", "c"]),
    ("SELECT ';'", ["SELECT ';'"]), ("SELECT ';';SELECT \";\"", ["SELECT ';'", 'SELECT ";"']),
    (r"SELECT 'it\'s; so'; x", [r"SELECT 'it\'s; so'", "x"]),
    ("SELECT 'it''s; so'; x", ["SELECT 'it''s; so'", "x"]),
    (r"SELECT '\\'; x", [r"SELECT '\\'", "x"]), (r"SELECT r'\'; x", [r"SELECT r'\'", "x"]),
    (r"SELECT R""\"\\\";\" ; x".replace("\\\\\\\"", "\\\""), ["SELECT R\"\\\"", "\" ; x"]),
    ("SELECT attr';'", ["SELECT attr';'"]),
    ("SELECT `a;b`, `c``;d`; x", ["SELECT `a;b`, `c``;d`", "x"]),
    ("a -- no; end\n b; c", ["a -- no; end\n b", "c"]),
    ("a /* ; /* ; */ ; */ b; c", ["a /* ; /* ; */ ; */ b", "c"]),
    ("-- only; a comment\n; /* and ; this */ ; x", ["x"]),
    ("SELECT /*+ REPARTITION(2) */ 1; -- end", ["SELECT /*+ REPARTITION(2) */ 1"]),
    ("SELECT 'open; text", ["SELECT 'open; text"]), ("x /* open ; y", ["x /* open ; y"]),
    ("SELECT 1 - -1; SELECT 4/2", ["SELECT 1 - -1", "SELECT 4/2"]),
])
def test_split_statements(text, expected):
    assert split_statements(text) == expected


def test_parameters():
    assert parameters("SELECT :a, ':b', `:c`, x::int, :d_1 -- :e\n /* :f */") == {"a", "d_1"}


def test_statements_run_whole(spark, local_dir):
    path = os.path.join(local_dir, "script.sql")
    with open(path, "w") as fh:
        fh.write("-- first; second\nSELECT 1;\n/* ; */ SELECT concat(';', :p, '`;`') AS `a;b`;\n-- end;")
    row = S.run_sql_files(spark, path, {"p": "x", "unused": 1}).first()
    assert row["a;b"] == ";x`;`"
    assert S.scalar_value(spark, "SELECT ';' -- one;") == ";"
    assert S.scalar_value(spark, "SELECT ':p', :p;", {"p": 5}) == ":p"


def test_scalar_takes_one_statement(spark, local_dir):
    for sql in ("SELECT 1; SELECT 2;", "", "-- nothing"):
        with pytest.raises(ValueError):
            S.scalar_value(spark, sql)
    path = os.path.join(local_dir, "two.sql")
    with open(path, "w") as fh:
        fh.write("SELECT 1;\nSELECT 2;")
    with pytest.raises(ValueError):
        S.scalar_from_file(spark, path)
    with open(path, "w") as fh:
        fh.write("SELECT max(id) FROM range(:n); -- done;")
    assert S.scalar_from_file(spark, path, {"n": 5}) == "4"

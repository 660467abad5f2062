import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sqlyard.functions.names import missing_columns
from sqlyard.functions import fixed
from sqlyard.functions import text as T

CLEAN = [
    ("```sql\nSELECT a FROM t;\n```", "SELECT a FROM t"),
    ("SELECT a\n\nThis finds a.", "SELECT a"),
    ("SELECT a ### Question: b; c", "SELECT a"),
    ('SELECT a FROM t WHERE x = "a;b"; SELECT 2', 'SELECT a FROM t WHERE x = "a'),
    ("```\n```", ""),
    ("  ", ""),
    ("\u00a0SELECT 1\u2003", "SELECT 1"),
    ("```sql SELECT 1 ``` ```", "SELECT 1 ```"),
    ("SELECT 1````", "SELECT 1`"),
    ("```\u00e9t\u00e9 SELECT 1", "SELECT 1"),
]


def scanned(s):
    """What should be left, found by looking at one character after another."""
    def trim(first, stop):
        while first < stop and s[first].isspace():
            first += 1
        while stop > first and s[stop - 1].isspace():
            stop -= 1
        return first, stop

    first, stop = trim(0, len(s))
    if s.startswith("```", first, stop):
        first += 3
        while first < stop and (s[first].isalnum() or s[first] == "_"):
            first += 1
        first, _ = trim(first, stop)
    if stop - first >= 3 and s.endswith("```", first, stop):
        stop -= 3
    first, stop = trim(first, stop)
    for mark in ("###", "\n\n", ";"):
        at = next((i for i in range(first, stop) if s.startswith(mark, i, stop)), stop)
        first, stop = trim(first, at)
    return s[first:stop]


def test_blanks_are_pythons():
    assert set(fixed.BLANKS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    blank = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), fixed.BLANK))
    assert {chr(i) for i in range(0x110000) if blank.fullmatch(chr(i))} == set(fixed.BLANKS)


def test_clean_prediction(eval_column):
    got = eval_column([(i,) for i, _ in CLEAN], ["s"], T.clean_prediction("s"))
    assert got == [o for _, o in CLEAN]
    assert got == [scanned(i) for i, _ in CLEAN]


pieces = st.lists(st.sampled_from(
    ["```", "`", "sql", "SELECT a", " ", "\n", "\n\n", ";", "###", "##", "\t", "\u00a0", "x"]
), max_size=10).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(pieces, min_size=40, max_size=40))
def test_clean_prediction_like_python(eval_column, texts):
    assert eval_column([(t,) for t in texts], ["s"], T.clean_prediction("s")) == [scanned(t) for t in texts]


@pytest.mark.parametrize("sql,want", [
    ("SELECT  Name FROM\n t ;", "select Name from t"),
    ("select COUNT(*)  from T WHERE x = 'A  B'", "select COUNT(*) from T where x = 'A B'"),
    ("SELECT a -- note; here\nFROM t", "select a from t"),
    ("SELECT a /* SELECT\n b */ FROM t;;", "select a from t"),
    ("SELECT '-- not' FROM t", "select '-- not' from t"),
    ("SELECT t.ORDER, ORDER.x FROM t ORDER BY t . GROUP", "select t.ORDER, ORDER.x from t order by t . group"),
    ("SELECT a FROM t WHERE b IN(1) AND MAX(c) > 1", "select a from t where b in(1) and MAX(c) > 1"),
    ('SELECT "Order" , `Group`, [Select] FROM t', 'select "Order" , `Group`, [Select] from t'),
    ("SELECT it's FROM t", "select it's from t"),
    ("", ""), ("  ;  ", ""), ("\u00a0SELECT\u20031", "select 1"),
])
def test_normalize(eval_column, sql, want):
    assert eval_column([(sql,)], ["s"], T.normalize_sql("s")) == [want]


def test_normalize_is_stable_and_takes_more_keywords(eval_column):
    sql = "SELECT Name, Year FROM t -- x"
    once = T.normalize_sql("s")
    assert eval_column([(sql,)], ["s"], T.normalize_sql(once)) == ["select Name, Year from t"]
    more = T.normalize_sql("s", fixed.KEYWORDS + ["year"])
    assert eval_column([(sql,)], ["s"], more) == ["select Name, year from t"]


def test_long_texts_do_not_exhaust_the_stack(eval_column):
    long_sql = "SELECT '" + "x" * 200_000 + "' FROM t /* " + "y*" * 100_000 + " */" + " AND a = 'b'" * 20_000
    long_ddl = "CREATE TABLE t (a TEXT DEFAULT 'a;b' -- c;\n);" * 20_000
    assert len(eval_column([(long_sql,)], ["s"], T.normalize_sql("s"))[0]) > 400_000
    assert eval_column([(long_ddl,)], ["s"], F.size(T.ddl_statements("s"))) == [20_000]


@pytest.mark.parametrize("ddl,want", [
    ("CREATE TABLE a (x INT); CREATE TABLE b (y TEXT)", ["CREATE TABLE a (x INT);", "CREATE TABLE b (y TEXT)"]),
    ("CREATE TABLE a (x TEXT DEFAULT 'p;q');\n\n", ["CREATE TABLE a (x TEXT DEFAULT 'p;q');"]),
    ("a -- one; two\n; b /* ; */", ["a -- one; two\n;", "b /* ; */"]),
    ("it's; fine", ["it's;", "fine"]),
    ("CREATE TABLE a (x INT); CREATE TRIGGER t AFTER INSERT ON a BEGIN UPDATE a SET x = CASE WHEN x > 1 THEN 0 END; DELETE FROM a; END; SELECT 1;",
     ["CREATE TABLE a (x INT);", "CREATE TRIGGER t AFTER INSERT ON a BEGIN UPDATE a SET x = CASE WHEN x > 1 THEN 0 END;\nDELETE FROM a;\nEND;", "SELECT 1;"]),
    ("create temp trigger t begin select 'end;' as \"begin\"; end; BEGIN; COMMIT; END;", ["create temp trigger t begin select 'end;' as \"begin\";\nend;", "BEGIN;", "COMMIT;", "END;"]),
    ("CREATE TRIGGER t BEGIN SELECT 1; SELECT 2", ["CREATE TRIGGER t BEGIN SELECT 1;\nSELECT 2"]),
    ("CREATE TABLE begin_log (a INT); INSERT INTO begin_log VALUES (1);", ["CREATE TABLE begin_log (a INT);", "INSERT INTO begin_log VALUES (1);"]),
    ("  ", []), ("", []),
])
def test_ddl_statements(eval_column, ddl, want):
    assert eval_column([(ddl,)], ["s"], T.ddl_statements("s")) == [want]


def test_missing_tables(eval_column):
    schema = "CREATE TABLE employees (id INT); create table IF NOT EXISTS \"Scores\" (x INT);"
    rows = [
        ("SELECT * FROM Employees JOIN scores ON 1 = 1", schema),
        ("SELECT * FROM staff JOIN employees ON x JOIN staff ON y", schema),
        ("SELECT 1", schema),
        ("SELECT * FROM employees", ""),
    ]
    assert eval_column(rows, ["q", "s"], T.missing_tables("q", "s")) == [[], ["staff"], [], ["employees"]]


@pytest.mark.parametrize("sql, tables, columns", [
    ("SELECT * FROM a, zz", ["zz"], []), ("SELECT * FROM a x, b AS y, zz z", ["zz"], []), ("SELECT * FROM [zz]", ["zz"], []),
    ("SELECT * FROM `a` JOIN [b] ON a.id = b.id", [], []), ("WITH t AS (SELECT * FROM a) SELECT * FROM t", [], []),
    ("WITH t AS (SELECT 1), u (x) AS (SELECT * FROM zz) SELECT * FROM t, u", ["zz"], []),
    ("SELECT EXTRACT(YEAR FROM d) FROM a", [], []), ("SELECT TRIM(BOTH ' ' FROM name) FROM b WHERE id = 1", [], []),
    ("SELECT * FROM a WHERE d = 'from nowhere'", [], []), ("SELECT * FROM a WHERE id IS DISTINCT FROM b.id", [], ["id"]),
    ("SELECT 1 -- from x\nFROM a", [], []), ("SELECT 1 /* FROM x */ FROM main.a", [], []), ('SELECT * FROM main."ZZ"', ["zz"], []),
    ("SELECT * FROM (SELECT * FROM zz) q", ["zz"], []), ("SELECT * FROM a LEFT JOIN yy ON a.id = yy.id", ["yy"], []),
    ("SELECT * FROM a WHERE nope = 3", [], ["nope"]), ("SELECT * FROM a WHERE a.nope > 3 ORDER BY id", [], ["nope"]),
    ("SELECT * FROM a WHERE 3 < Nope", [], ["nope"]), ("SELECT id k FROM a WHERE [d] = 'x' AND \"id\" <> 2", [], []),
    ("SELECT count(*) AS n FROM a GROUP BY d HAVING n > 3", [], []), ("SELECT id FROM a WHERE d = CURRENT_DATE AND lower(d) = upper(d)", [], []),
    ("SELECT id FROM a WHERE d IN (SELECT nope FROM b WHERE nope = 1)", [], ["nope"]), ("SELECT a.id FROM a JOIN b ON a.id = b.amount", [], []),
])
def test_names_in_queries(eval_column, sql, tables, columns):
    schema = "CREATE TABLE a (id INT PRIMARY KEY, d DATE); CREATE TEMP TABLE \"B\" (id INT, name TEXT, amount DECIMAL(10, 2), PRIMARY KEY (id));"
    assert eval_column([(sql, schema)], ["q", "s"], T.missing_tables("q", "s")) == [tables]
    assert eval_column([(sql, schema)], ["q", "s"], missing_columns("q", "s")) == [columns]


def test_small_functions(eval_column):
    assert eval_column([(" SELECT 1 ;; ",), ("",)], ["s"], T.with_stop_mark("s")) == ["SELECT 1 ;", ";"]
    assert eval_column([(" Select 1",), ("x",)], ["s"], T.loose_match("s", F.lit("SELECT 1 "))) == [True, False]
    assert eval_column([("",), (" \n",), ("SELEC",)], ["s"], T.is_valid_sql("s")) == [False, False, True]
    assert eval_column([("a b c",), ("",)], ["s"], T.tokens("s")) == [["a", "b", "c"], []]


def test_round_even_like_python(eval_column):
    rng = random.Random(3)
    values = [k / n * 100 for n in (3, 7, 8, 160, 800, 1600, 4000) for k in range(0, n, max(1, n // 200))]
    values += [0.5, 1.5, 2.675, -0.125, 1.005, -2.675] + [rng.uniform(-100, 100) for _ in range(2000)]
    for places in (0, 1, 2, 4, 6):
        got = eval_column([(repr(v),) for v in values], ["s"], T.round_even(F.col("s").cast("double"), places))
        assert got == [round(v, places) for v in values]

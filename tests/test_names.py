"""Columns looked up in the tables of their own bracket level."""

import pytest
from pyspark.sql import functions as F

from sqlyard.functions import fixed, names

SCHEMA = """CREATE TABLE players (id INT PRIMARY KEY, name TEXT, "full name" TEXT, season INT, team_id INT, born DATE);
    CREATE TABLE teams (team_id INT, city TEXT, rank INT, CHECK (rank > 0)); CREATE TABLE notes AS SELECT 1"""


@pytest.mark.parametrize("sql, columns", [
    # every clause
    ("SELECT nam FROM players", ["nam"]), ("SELECT name FROM players ORDER BY sesson", ["sesson"]),
    ("SELECT name FROM players WHERE nope BETWEEN 1 AND 2", ["nope"]), ("SELECT name FROM players WHERE nope LIKE 'a%'", ["nope"]),
    ("SELECT name FROM players WHERE nope IS NOT NULL AND other IN (1, 2)", ["nope", "other"]), ("SELECT count(DISTINCT nope) FROM players", ["nope"]),
    ("SELECT team_id, max(season) FROM players GROUP BY tem_id HAVING min(sason) > 1", ["tem_id", "sason"]),
    ("SELECT CASE WHEN nope = 1 THEN name ELSE born END kind FROM players", ["nope"]), ("SELECT name FROM players JOIN teams ON nope = rank", ["nope"]),
    ("SELECT name FROM players WHERE 1 < -nope", ["nope"]), ("SELECT sum(season) OVER (PARTITION BY nope ORDER BY born) FROM players", ["nope"]),
    ("SELECT name FROM players JOIN teams USING (team_id, nope)", ["nope"]), ("SELECT `nope`, [neither] FROM players", ["nope", "neither"]),
    # qualified
    ("SELECT p.name, t.name FROM players p JOIN teams AS t ON p.team_id = t.team_id", ["name"]), ("SELECT x.name FROM players", ["name"]),
    ("SELECT players.season FROM players", []), ("SELECT main.players.nope FROM main.players", ["nope"]), ("SELECT p.* FROM players p", []),
    ('SELECT p."full name", p."no name" FROM players p', ["no name"]), ('SELECT "players"."name" FROM players', []),
    # literals, typed literals, row ids, names of functions and types
    ('SELECT name FROM players WHERE season = "2010"', []), ("SELECT name FROM players WHERE born > DATE '2020-01-01'", []),
    ("SELECT rowid, players.oid FROM players WHERE _rowid_ = 1", []), ("SELECT CAST(season AS real), trim(BOTH ' ' FROM name) FROM players", []),
    ("SELECT extract(year FROM born) FROM players", []), ("SELECT name FROM players WHERE born = CURRENT_DATE AND season IS NOT DISTINCT FROM rank", ["rank"]),
    ("SELECT name FROM players WHERE name = 'it''s nope' -- nope\n AND /* nope */ season = 1e5", []), ("SELECT left(name, 2), 'a' || name FROM players", []),
    ("SELECT name FROM players WHERE born > INTERVAL '1' DAY + born COLLATE nocase LIMIT 5 OFFSET 2", []), ("SELECT name FROM players FETCH FIRST 3 ROWS ONLY", []),
    # names of its own
    ("SELECT season + 1 AS nxt, name who FROM players WHERE nxt > 2 ORDER BY who", []), ("SELECT count(*) n FROM players GROUP BY team_id HAVING n > 3", []),
    ("SELECT 1 AS \"a b\" FROM players", []),
    # levels
    ("SELECT name FROM players WHERE team_id IN (SELECT team_id FROM teams WHERE season = 1 AND city = name)", []),
    ("SELECT city FROM teams WHERE team_id IN (SELECT team_id FROM players WHERE cty = 'x')", ["cty"]),
    ("SELECT season FROM teams WHERE EXISTS (SELECT 1 FROM players WHERE players.team_id = teams.team_id)", ["season"]),
    ("SELECT name FROM players p WHERE season = (SELECT max(q.season) FROM players q WHERE q.city = p.city)", ["city"]),
    ("SELECT q.anything, bare FROM (SELECT nope FROM teams) q", ["nope"]), ("SELECT bare FROM (SELECT 1) AS q, players p WHERE p.nope = 1", ["nope"]),
    ("WITH x AS (SELECT nope FROM players) SELECT bare FROM x", ["nope"]), ("WITH RECURSIVE x (a, b) AS (SELECT 1, 2), y AS (SELECT 3) SELECT c FROM y, x WHERE x.d = 1", []),
    ("SELECT name FROM players UNION SELECT name FROM teams", ["name"]), ("SELECT city FROM teams UNION ALL SELECT name FROM players ORDER BY whatever", []),
    ("(SELECT nope FROM players)", ["nope"]), ("SELECT name FROM (players JOIN teams ON nope = 1)", ["nope"]),
    ("SELECT a.city, b.name FROM teams a, (players AS b)", []), ("SELECT name FROM players WHERE (season > 1 OR (nope = 1))", ["nope"]),
    # undecidable
    ("SELECT nope FROM players, strangers", []), ("SELECT nope FROM notes", []), ("SELECT notes.nope FROM notes", []), ("SELECT nope FROM generate(3) g", []),
    ("SELECT p.nope, bare FROM players p, strangers", ["nope"]), ("DELETE FROM players WHERE nope = 1", []), ("no query at all", []), ("", []),
    ("SELECT name FROM players WHERE )) ((", []), ("SELECT nope", ["nope"]),
])
def test_missing_columns(eval_column, sql, columns):
    assert eval_column([(sql, SCHEMA)], ["q", "s"], names.missing_columns("q", "s")) == [columns]


def test_without_schema(eval_column):
    rows = [("SELECT nope FROM players", s) for s in ("", None, "CREATE VIEW players AS SELECT 1", "no ddl")]
    assert eval_column(rows, ["q", "s"], names.missing_columns("q", "s")) == [[]] * 4


def test_declared(eval_column):
    assert eval_column([(SCHEMA,)], ["s"], F.to_json(names.declared("s"))) == [
        '[{"table":"players","columns":["id","name","full name","season","team_id","born"]},'
        '{"table":"teams","columns":["team_id","city","rank"]},{"table":"notes","columns":[]}]']


def test_long_text(eval_column):
    sql = "SELECT name FROM players WHERE " + " OR ".join(f"(season = {i} AND name = 'x')" for i in range(400)) + " AND nope = 1"
    assert eval_column([(sql, SCHEMA)], ["q", "s"], names.missing_columns("q", "s")) == [["nope"]]


def test_a_query_is_read_once(spark):
    """Tokens and the schema's statements are computed once per query: inside functions over arrays each mention of an expression is
    computed anew, for every token or column."""
    rows = spark.range(1).select(F.col("id").cast("string").alias("sql"))
    plan = rows.select(names.missing_columns("sql", "sql").alias("missing"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(fixed.NAME_TOKEN) == 1
    assert plan.count(fixed.DDL_STATEMENT_JAVA) == 1

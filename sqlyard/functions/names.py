"""Which columns a query reads that its schema lacks: names are bound to the tables of their own bracket level.

A query's tokens are folded with a stack of brackets. A bracket that opens a SELECT opens a level with tables of its own; any
other bracket belongs to the level around it. Each level collects the tables and aliases of its FROM, the names it gives itself,
and the columns it reads, and a column is looked up in its own level and those around it. The fold looks at neighbouring
tokens only; it builds no tree and accepts texts that no engine would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sqlyard.functions import fixed
from sqlyard.functions.text import bound, col, ddl_statements, declared_columns_of

_FRAME = "struct<path:array<int>,clause:string,own:boolean,compound:boolean>"
_ITEM = "struct<role:string,path:array<int>,qualifier:string,name:string>"
_STATE = f"struct<prev:string,operand:boolean,last:string,n:int,top:{_FRAME},frames:array<{_FRAME}>,found:array<{_ITEM}>>"
_FIELDS = ["prev", "operand", "last", "n", "top", "frames", "found"]
_SIDES = ["inner", "left", "right", "full", "cross", "natural", "outer"]
_CLAUSES = ["where", "group", "having", "order", "qualify"]
_ENDS = ["limit", "offset", "fetch"]
# words that may open a clause
_OPENING = ["union", "except", "intersect", "select", "with", "from", "join", "on", "using", "window", *_SIDES, *_CLAUSES, *_ENDS]


def _parts(name: Column) -> Column:
    """A qualified name's parts in lower case, without quotes."""
    return F.transform(F.regexp_extract_all(name, F.lit("(" + fixed.NAME + ")"), F.lit(1)),
                       lambda p: F.lower(F.regexp_replace(p, r'''^["`\[]|["`\]]$''', "")))


def tokens(sql: Column | str) -> Column:
    """``(text, word, next)`` per token: as written, in lower case, and the lower-cased token behind it; no comments or blanks."""
    found = F.filter(F.regexp_extract_all(col(sql), F.lit(fixed.NAME_TOKEN), F.lit(1)), lambda t: t != "")
    return bound(found, lambda all_: F.transform(all_, lambda t, i: F.struct(
        t.alias("text"), F.lower(t).alias("word"), F.coalesce(F.lower(F.get(all_, i + 1)), F.lit("")).alias("next"))))


def _read(found: Column) -> Column:
    """What the fold asks of a token again and again, found once per token. ``parts`` is null where the token is no name."""
    kept = ("text", "word", "next")

    def kind(t: Column) -> Column:
        w = t["word"]
        return F.struct(
            *[t[k].alias(k) for k in kept], w.rlike(r"^[\p{L}_]").alias("is_word"), w.isin([k.lower() for k in fixed.KEYWORDS]).alias("keyword"),
            w.isin(_OPENING).alias("opening"))

    def name(t: Column) -> Column:
        w, text = t["word"], t["text"]
        # a quoted word alone may be text
        is_name = t["is_word"] | w.rlike(r"^[`\[]") | (w.rlike('^"') & w.rlike(r'"\s*\.'))
        # what the next token finds behind it
        operand = F.when(t["is_word"], ~t["keyword"] | (w == "end")).otherwise(is_name | w.rlike(r"""^['"0-9)]"""))
        return F.struct(
            *[t[k].alias(k) for k in (*kept, "is_word", "keyword", "opening")], is_name.alias("is_name"), operand.alias("operand"),
            F.when(t["is_word"] & ~F.contains(w, F.lit(".")), F.array(w)).when(is_name, _parts(text)).alias("parts"))

    return F.transform(F.transform(found, kind), name)


def _with(s: Column, **changes: Column) -> Column:
    return F.struct(*[(changes.get(f, s[f])).alias(f) for f in _FIELDS])


def _frame(path: Column, clause: Column | str, own: Column, compound: Column) -> Column:
    clause = F.lit(clause) if isinstance(clause, str) else clause
    return F.struct(path.alias("path"), clause.alias("clause"), own.alias("own"), compound.alias("compound"))


def _item(role: str, path: Column, qualifier: Column, name: Column) -> Column:
    return F.array(F.struct(F.lit(role).alias("role"), path.alias("path"), qualifier.alias("qualifier"), name.alias("name")))


def _step(s: Column, t: Column) -> Column:
    w, after, prev = t["word"], t["next"], s["prev"]
    top, rest = s["top"], s["frames"]
    path, clause, own, compound, yes, no = top["path"], top["clause"], top["own"], top["compound"], F.lit(True), F.lit(False)
    none = F.lit(None).cast("string")
    is_word, keyword, parts = t["is_word"], t["keyword"], t["parts"]

    def moved(**changes: Column) -> Column:
        return _with(s, prev=w, operand=t["operand"], **changes)

    def in_clause(name: Column | str, compound_: Column = compound, path_: Column = path, **changes: Column) -> Column:
        return moved(top=_frame(path_, name, own, compound_), **changes)

    def seen(role: str, qualifier: Column, name: Column, **changes: Column) -> Column:
        return moved(found=F.concat(s["found"], _item(role, path, qualifier, name)), **changes)

    opens, at_table = after.isin("select", "with", "values"), prev.isin("from", "join", ",", "(", "lateral", "only")
    nested = (clause == "from") & own & at_table & ~opens
    # a subquery in FROM or WITH does not see the tables beside it
    around = F.when(own & ((clause == "with") | ((clause == "from") & (prev != "lateral"))), F.slice(path, 1, F.size(path) - 1)).otherwise(path)
    opened = _frame(F.when(opens, F.concat(around, F.array(s["n"]))).otherwise(path), F.when(opens, "").otherwise(clause), opens | nested, no)
    outer = F.element_at(rest, -1)
    derived = (F.element_at(path, -1) != F.element_at(outer["path"], -1)) & (outer["clause"] == "from") & outer["own"]
    closed = F.when(derived, F.concat(s["found"], _item("table", outer["path"], none, none))).otherwise(s["found"])

    name, qualifier = F.element_at(parts, -1), F.when(F.size(parts) > 1, F.get(parts, F.size(parts) - 2))
    no_column = (
        (is_word & keyword & (F.size(parts) == 1)) | (after == "(") | (after == ".") | after.startswith("'")
        | (after.startswith('"') & (F.size(parts) == 1)) | ((after == "from") & ~own) | prev.isin("collate", "window", "over")
        | name.isin(fixed.ROW_IDS) | clause.isin("skip", "with", "set", "values"))
    outside = (
        F.when(no_column, moved())
        .when((prev == "as") | s["operand"], seen("named", none, name))
        .otherwise(seen("column", qualifier, name)))
    table = F.when(after == "(", none).otherwise(name)
    in_from = (
        F.when(at_table, seen("table", name, table, last=table))
        .when(is_word & keyword, moved())
        .when((prev == "as") | s["operand"], seen("table", name, s["last"]))
        .otherwise(moved()))

    # null where the word opens no clause here
    of_clause = (
        F.when(w.isin("union", "except", "intersect"), in_clause("set", yes))
        .when((w == "select") & (clause == "set"),
              in_clause("select", yes, F.concat(F.slice(path, 1, F.size(path) - 1), F.array(s["n"])), n=s["n"] + 1))
        .when(w == "select", in_clause("select"))
        .when((w == "with") & (clause == ""), in_clause("with"))
        .when((w == "from") & (prev != "distinct"), in_clause("from"))
        .when(clause.isin("from", "on") & ((w == "join") | (w.isin(_SIDES) & (after != "("))), in_clause("from"))
        .when((clause != "with") & w.isin("on", "using"), in_clause("on"))
        .when((w == "order") & compound, in_clause("skip"))
        .when(w.isin(_CLAUSES) & (clause != "") & (prev != "within"), in_clause(w))
        .when(w == "window", in_clause("on"))
        .when(w.isin(_ENDS) & (clause != "select"), in_clause("skip")))
    of_name = (
        F.when(own & (clause == "with") & prev.isin("with", "recursive", ","), seen("given", none, name))
        .when(own & (clause == "from"), in_from)
        .otherwise(outside))
    return (
        F.when(t["is_name"], F.coalesce(F.when(own & t["opening"], of_clause), of_name))
        .when(w == "(", moved(top=opened, frames=F.concat(rest, F.array(top)), n=s["n"] + opens.cast("int")))
        .when((w == ")") & (F.size(rest) > 0), moved(
            top=outer, frames=F.slice(rest, 1, F.size(rest) - 1), found=closed, last=F.when(derived, none).otherwise(s["last"])))
        .otherwise(moved()))


def names(sql: Column | str) -> Column:
    """``(role, path, qualifier, name)`` of every table, column and name of its own a query mentions, in order.

    ``path`` holds the numbers of the levels around it, its own last. Roles: ``table`` (``qualifier`` is what columns may call
    it; ``name`` is null for a subquery or function), ``column``, ``named`` (an alias), ``given`` (a name that WITH gives).
    """
    base = _frame(F.array(F.lit(0)), "", F.lit(True), F.lit(False))
    start = F.struct(F.lit("").alias("prev"), F.lit(False).alias("operand"), F.lit(None).cast("string").alias("last"), F.lit(1).alias("n"),
                     base.alias("top"), F.array().cast(f"array<{_FRAME}>").alias("frames"), F.array().cast(f"array<{_ITEM}>").alias("found"))
    # only the start is cast: a cast in the fold would copy all that is found, token by token
    return F.aggregate(_read(tokens(sql)), start.cast(_STATE), _step, lambda s: s["found"])


def declared(schema: Column | str) -> Column:
    """``(table, columns)`` of every table a DDL text creates, in lower case; no columns where the text lists none."""
    def one(statement: Column) -> Column:
        full = F.regexp_extract(statement, fixed.DECLARED_TABLE, 1)
        return F.struct(F.element_at(_parts(full), -1).alias("table"), declared_columns_of(statement).alias("columns"))

    creates = F.filter(ddl_statements(schema), lambda d: d.rlike(fixed.DECLARED_TABLE))
    return F.transform(creates, one)


def missing_columns(sql: Column | str, schema: Column | str) -> Column:
    """Columns a query reads that no table in reach declares, once each, in lower case.

    Only what the texts decide. A qualified column is missing where its table is declared without it, or where nothing in reach
    has that name. A bare one is missing where every table in reach is declared, with its columns, and none has it, and no
    alias of the levels around has its name. Where a table in reach is a subquery, a function, a name that WITH gives, or not
    declared, bare columns are left open. Quoted and typed literals, row ids and keywords are no columns, nor is a word in
    double quotes that stands alone; ORDER BY behind UNION is not looked at, nor are statements other than SELECT.
    """
    def look(found: Column, tables: Column) -> Column:
        given = F.transform(F.filter(found, lambda x: x["role"] == "given"), lambda x: x["name"])
        bound_ = F.transform(F.filter(found, lambda x: x["role"] == "table"), lambda x: F.struct(
            F.element_at(x["path"], -1).alias("level"), x["qualifier"].alias("qualifier"),
            F.when(~F.array_contains(given, F.coalesce(x["name"], F.lit(""))), F.get(F.filter(tables, lambda d: (d["table"] == x["name"]) & (F.size(d["columns"]) > 0)), F.lit(0))["columns"]).alias("columns")))
        named_ = F.filter(found, lambda x: x["role"] == "named")
        columns = F.filter(found, lambda x: x["role"] == "column")

        def lacking(c: Column, in_reach: Column, named: Column) -> Column:
            reach = F.filter(in_reach, lambda b: F.array_contains(c["path"], b["level"]))
            own = F.filter(reach, lambda b: b["qualifier"] == c["qualifier"])
            has = lambda b: F.array_contains(b["columns"], c["name"])
            bare = ~F.exists(reach, lambda b: b["columns"].isNull() | has(b)) & ~F.exists(
                named, lambda x: (x["name"] == c["name"]) & F.array_contains(c["path"], F.element_at(x["path"], -1)))
            return F.when(c["qualifier"].isNull(), bare).otherwise(~F.exists(own, lambda b: b["columns"].isNull() | has(b)))

        # the tables in reach are bound once per query, not once per column
        return bound(F.struct(bound_.alias("tables"), named_.alias("named")), lambda b: F.array_distinct(F.transform(
            F.filter(columns, lambda c: lacking(c, b["tables"], b["named"])), lambda c: c["name"])))

    none = F.array().cast("array<string>")
    read = bound(declared(schema), lambda tables: F.when(
        F.size(tables) > 0, bound(names(sql), lambda found: look(found, tables))).otherwise(none))
    return F.when(col(sql).rlike(fixed.QUERY_START), read).otherwise(none)

"""Column functions on prediction and SQL text. All run inside the JVM, row by row, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sqlyard.functions import fixed


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it: also inside functions over arrays, where
    Spark computes an expression anew at each mention and for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Text without blanks at either end (the blanks Python's ``str.strip`` removes)."""
    return F.btrim(col(c), F.lit(fixed.BLANKS))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


# ---- prediction clean-up ----------------------------------------------------------------------

def strip_opening_fence(c: Column | str) -> Column:
    return F.regexp_replace(col(c), fixed.OPENING_FENCE, "")


def strip_closing_fence(c: Column | str) -> Column:
    """Drop a code fence at the end, with the blanks around it; other text stays as it is."""
    text = col(c)
    body = F.rtrim(text, F.lit(fixed.BLANKS))
    cut = F.rtrim(F.left(body, F.length(body) - len(fixed.CLOSING_FENCE)), F.lit(fixed.BLANKS))
    return F.when(F.endswith(body, F.lit(fixed.CLOSING_FENCE)), cut).otherwise(text)


def before(c: Column | str, mark: str) -> Column:
    """Stripped text before the first ``mark``; all of it when there is none."""
    return strip(F.substring_index(col(c), mark, 1))


def clean_prediction(c: Column | str) -> Column:
    """Bare SQL from raw model output: no fences, only the first section, paragraph and statement."""
    text = strip(strip_closing_fence(strip_opening_fence(strip(c))))
    for mark in (fixed.SECTION_MARK, fixed.BLANK_LINE, fixed.STATEMENT_END):
        text = before(text, mark)
    return text


# ---- SQL text ---------------------------------------------------------------------------------

def drop_end_marks(c: Column | str) -> Column:
    """Stripped text without the semicolons at its end."""
    return F.rtrim(strip(c), F.lit(fixed.STATEMENT_END))


def with_stop_mark(c: Column | str) -> Column:
    """The completion a model is trained on: stripped SQL that ends in exactly one semicolon."""
    return F.concat(drop_end_marks(c), F.lit(fixed.STATEMENT_END))


def normalize_sql(c: Column | str, keywords: list[str] | None = None) -> Column:
    """SQL made comparable: no comments, no end semicolons, keywords in lower case, single blanks.

    Only keywords change case; names, quoted text and a word directly before "(" or beside "."
    keep theirs. Blanks collapse inside quoted text too. ``keywords`` replaces the fixed list, for
    callers who need more words than SQL reserves.
    """
    words = [w.upper() for w in (keywords or fixed.KEYWORDS)]
    words += [w + "(" for w in fixed.KEYWORDS_BEFORE_BRACKET]

    def plain(token: Column, comments: bool) -> Column:
        found = F.when(token == " ", token).when(F.upper(token).isin(words), F.lower(token))
        if comments:
            found = found.when(reduce(Column.__or__, [F.startswith(token, F.lit(m)) for m in fixed.COMMENT_STARTS]), F.lit(" "))
        return found.otherwise(token)

    def normal(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(fixed.SQL_TOKEN), F.lit(0))
        # most texts hold no mark of a comment, so their tokens are not asked for one
        marked = reduce(Column.__or__, [F.contains(text, F.lit(m)) for m in fixed.COMMENT_STARTS])
        joined = F.array_join(F.when(marked, F.transform(found, lambda t: plain(t, True))).otherwise(F.transform(found, lambda t: plain(t, False))), "")
        return bound(joined, lambda j: strip(F.when(j.rlike(fixed.MAY_COLLAPSE), F.regexp_replace(j, fixed.BLANK + "+", " ")).otherwise(j)))

    return bound(strip(drop_end_marks(c)), normal)


def tokens(normalized: Column | str) -> Column:
    """Words of normalised SQL (blanks are single there); no words for empty text."""
    text = col(normalized)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def is_valid_sql(c: Column | str) -> Column:
    """True unless blank. The parser behind the original metric rejects nothing else."""
    return strip(c) != ""


def ddl_statements(c: Column | str) -> Column:
    """Non-empty statements of a DDL text, in order, each with its semicolon.

    The body of a trigger, function or procedure between BEGIN and its END belongs to the statement that opens it, with the
    semicolons in it; a CASE inside has an END of its own.
    """
    found = F.filter(F.transform(F.regexp_extract_all(col(c), F.lit(fixed.DDL_STATEMENT_JAVA), F.lit(0)), strip), lambda s: s != "")

    def words(piece: Column, pattern: str) -> Column:
        bare = F.regexp_replace(_names_only(piece), r'"[^"]*"|`[^`]*`|\[[^\]]*\]', " ")
        return F.size(F.regexp_extract_all(bare, F.lit(pattern), F.lit(0)))

    def join(s: Column, piece: Column) -> Column:
        inside = (s["open"] > 0) | piece.rlike(fixed.STATEMENT_WITH_BODY)
        depth = s["open"] + words(piece, r"(?i)\b(?:begin|case)\b") - words(piece, r"(?i)\bend\b")
        body = F.concat(F.slice(s["done"], 1, F.size(s["done"]) - 1), F.array(F.concat(F.element_at(s["done"], -1), F.lit("\n"), piece)))
        return F.struct(
            F.when(inside, F.greatest(depth, F.lit(0))).otherwise(F.lit(0)).alias("open"),
            F.when(s["open"] > 0, body).otherwise(F.concat(s["done"], F.array(piece))).alias("done"))

    start = F.struct(F.lit(0).alias("open"), F.array().cast("array<string>").alias("done"))
    return bound(found, lambda all_: F.when(
        F.exists(all_, lambda s: s.rlike(fixed.STATEMENT_WITH_BODY)), F.aggregate(all_, start, join, lambda s: s["done"])).otherwise(all_))


def loose_match(a: Column | str, b: Column | str) -> Column:
    return F.lower(strip(a)) == F.lower(strip(b))


def _names_only(sql: Column | str) -> Column:
    """SQL without quoted text and comments; quoted names stay."""
    return F.regexp_replace(col(sql), fixed.NAMES_OR_TEXT, " $1")


def _last_part(name: Column) -> Column:
    """A name without qualifiers and quotes, in lower case."""
    part = F.regexp_extract(name, "(" + fixed.NAME + r")\s*$", 1)
    return F.lower(F.regexp_replace(part, r'''^["`\[]|["`\]]$''', ""))


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def read_tables(sql: Column | str) -> Column:
    """Lower-cased names of the tables a query reads, once each.

    Takes the lists after FROM and JOIN with their aliases, qualified and quoted names; names that WITH gives and the FROM
    of functions and of IS DISTINCT FROM are none. Behind a subquery in a list, names are not seen.
    """
    def listed(bare: Column) -> Column:
        items = F.flatten(F.transform(_found(bare, fixed.TABLE_LIST), lambda found: F.split(found, ",")))
        first = F.transform(items, lambda item: F.regexp_extract(item, r"^\s*(" + fixed.FULL_NAME + ")", 1))
        names = F.transform(F.filter(first, lambda name: name != ""), _last_part)
        return F.array_except(F.array_distinct(names), F.transform(_found(bare, fixed.WITH_NAME), _last_part))

    return bound(F.regexp_replace(_names_only(sql), fixed.OTHER_FROM, " "), listed)


def declared_tables(schema: Column | str) -> Column:
    """Lower-cased names a DDL text creates, once each."""
    return F.array_distinct(F.transform(_found(_names_only(schema), fixed.DECLARED_TABLE), _last_part))


def missing_tables(sql: Column | str, schema: Column | str) -> Column:
    """Tables a query reads that its schema does not declare.

    Both lists live in one row, so this is a set difference of two short arrays, not an anti-join.
    """
    return F.array_except(read_tables(sql), declared_tables(schema))


def declared_columns_of(statement: Column) -> Column:
    """Lower-cased columns of the table that one DDL statement creates, in order."""
    body = F.regexp_extract(_names_only(statement), fixed.TABLE_BODY, 1)
    flat = F.regexp_replace(F.regexp_replace(body, r"\([^()]*\)", ""), r"\([^()]*\)", "")
    first = F.transform(F.split(flat, ","), lambda part: F.regexp_extract(part, r"^\s*(" + fixed.NAME + ")", 1))
    named = F.filter(first, lambda name: (name != "") & ~F.lower(name).isin(fixed.NO_COLUMN))
    return F.transform(named, _last_part)


def declared_columns(schema: Column | str) -> Column:
    """Lower-cased columns of all tables a DDL text creates, once each."""
    return F.array_distinct(F.flatten(F.transform(ddl_statements(schema), declared_columns_of)))


# ---- numbers ----------------------------------------------------------------------------------

def round_even(c: Column | str, places: int = 0) -> Column:
    """Round a double as Python does: to the nearest by its exact binary value, exact ties to even.

    Scaling can turn a value just below or above a half into a half; the product's rounding error,
    found by splitting the value in two short halves, then says which side it was on.
    """
    x, scale = col(c).cast("double"), float(10 ** places)
    y = x * scale
    split = x * 134217729.0  # 2**27 + 1
    high = split - (split - x)
    error = (high * scale - y) + (x - high) * scale
    tie = y - F.floor(y) == 0.5
    whole = F.when(tie & (error < 0), F.floor(y)).when(tie & (error > 0), F.ceil(y)).otherwise(F.rint(y))
    return whole / scale

"""Texts, word lists and patterns that results depend on.

Nothing here is computed. Changing a value changes prompts, scores or statuses.
"""

# ---- fixed values: prompt texts --------------------------------------------------------------

SYSTEM_TEXT = (
    "You are a helpful SQL assistant. Given a database schema and a natural "
    "language question, generate the correct SQL query. Output ONLY a single "
    "SQL query, nothing else. Do not repeat any conditions."
)

# template name -> (prompt, answer part). {schema}, {question} and {sql} are filled with stripped text.
TEMPLATES = {
    "generic": (
        "### Task: Generate a single SQL query to answer the following question.\n"
        "Do not repeat any conditions or output multiple queries.\n\n"
        "### Database Schema:\n{schema}\n\n"
        "### Question:\n{question}\n\n"
        "### SQL Query:\n",
        "{sql}",
    ),
    "mistral-instruct": (
        "<s>[INST] " + SYSTEM_TEXT + "\n\n"
        "### Database Schema:\n{schema}\n\n"
        "### Question:\n{question} [/INST]",
        " {sql}</s>",
    ),
    "llama3-chat": (
        "<|begin_of_text|>"
        "<|start_header_id|>system<|end_header_id|>\n\n" + SYSTEM_TEXT + "<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\n"
        "### Database Schema:\n{schema}\n\n"
        "### Question:\n{question}<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n",
        "{sql}<|eot_id|>",
    ),
    "chatml": (
        "<|im_start|>system\n" + SYSTEM_TEXT + "<|im_end|>\n"
        "<|im_start|>user\n"
        "### Database Schema:\n{schema}\n\n"
        "### Question:\n{question}<|im_end|>\n"
        "<|im_start|>assistant\n",
        "{sql}<|im_end|>",
    ),
}

# First rule that fits a lower-cased model name wins. A rule is a list of word groups;
# it fits when the name contains at least one word of every group.
TEMPLATE_RULES = [
    ("mistral-instruct", [["instruct"], ["mistral"]]),
    ("llama3-chat", [["llama-3"], ["instruct", "chat"]]),
    ("chatml", [["qwen"]]),
    ("chatml", [["phi"]]),
]
DEFAULT_TEMPLATE = "generic"

DEFAULT_MODEL = "mistralai/Mistral-7B-v0.3"
DEFAULT_TEST_SIZE = 0.1
DEFAULT_SEED = 42

# ---- fixed values: request statuses ----------------------------------------------------------

STATUS_NO_QUESTION = "⚠️ Please enter a question."
STATUS_NO_SCHEMA = "⚠️ Please enter a database schema."
STATUS_OK = "✅ Query generated successfully"
STATUS_ERROR_PREFIX = "❌ Error: "

# ---- fixed values: characters and patterns ---------------------------------------------------

# The characters Python's str.strip() and \s treat as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029"
    "\u202f\u205f\u3000"
)
# The same characters as a class that both Java and RE2 read alike.
BLANK = (
    r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Found in every text whose blanks are not all single spaces, and in some others; much faster to look for than BLANK.
MAY_COLLAPSE = r"  |[\t\n\x0B\f\r\x1C\x1D\x1E\x1F]|[^\x00-\x7F]"
WORD = r"[\p{L}\p{N}_]"

OPENING_FENCE = "^```" + WORD + "*" + BLANK + "*"
CLOSING_FENCE = "```"
SECTION_MARK = "###"
BLANK_LINE = "\n\n"
STATEMENT_END = ";"

# One SQL token per match, in this order: word (with a "(" that follows at once, or with a dot and
# the word after it), quoted text, comment, word after a dot, run of other characters, any character.
# Java and RE2 read it alike (no look-around, no repeated groups).
SQL_TOKEN = "|".join([
    WORD + r"[\p{L}\p{N}_$#]*(?:\(|" + BLANK + r"*\.[\p{L}\p{N}_$#]*)?",
    r"'[^']*'",
    r'"[^"]*"',
    r"`[^`]*`",
    r"\[[^\[\]]+\]",
    r"--[^\r\n]*",
    r"# [^\r\n]*",
    r"/\*[\s\S]*?\*/",
    r"\.[\p{L}\p{N}_$#]+",
    r"[^\p{L}\p{N}_'" + '"' + r"`\[/#.-]+",
    r"[\s\S]",
])
COMMENT_STARTS = ("--", "# ", "/*")

# One DDL statement with its ";" per match; ";" inside quotes or comments does not end it.
# Java needs the possessive "++" to stay off the stack on long texts; RE2 has no "++" and no stack.
DDL_PIECES = (
    r"""(?:'[^']*'|"[^"]*"|--[^\r\n]*|/\*[\s\S]*?\*/|[^;'"/-]+|['"/-])"""
)
DDL_STATEMENT_JAVA = DDL_PIECES + "++;?|;"
DDL_STATEMENT_RE2 = DDL_PIECES + "+;?|;"

# A statement that may hold others between BEGIN and END.
STATEMENT_WITH_BODY = r"(?is)^\s*create\s+(?:or\s+replace\s+)?(?:temp\s+|temporary\s+)?(?:trigger|function|procedure)\b.*\bbegin\b"

# Names in SQL text, for Java's patterns. A name may be quoted, and qualified by others before a dot.
_QUOTED_NAME = r'''(?:"[^"]*+"|`[^`]*+`|\[[^\[\]]*+\])'''
NAME = r"(?:" + _QUOTED_NAME + r"|[\p{L}_][\p{L}\p{N}_$]*+)"
FULL_NAME = NAME + r"(?:\s*+\.\s*+" + NAME + ")*+"
# Quoted names stay (group 1); text in single quotes and comments go.
NAMES_OR_TEXT = "(" + _QUOTED_NAME + r")|'[^']*+'|--[^\r\n]*+|/\*[\s\S]*?\*/"
# A FROM that starts no list of tables.
OTHER_FROM = (
    r"(?i)\bis\s++(?:not\s++)?distinct\s++from\b|\b(?:extract|trim|substring|overlay|position)\s*+\([^()]*?\bfrom\b"
)
# Words that end a table's name and alias.
_NO_ALIAS = (
    r"(?!(?:as|on|using|where|join|inner|left|right|full|cross|natural|outer|lateral|group|order|having|limit|offset|fetch|union"
    r"|intersect|except|window|qualify|tablesample|set|select|values)\b)"
)
TABLE_LIST = (
    r"(?i)\b(?:from|join)\b\s*+((?:" + _NO_ALIAS + FULL_NAME + r"(?!\s*+\()(?:\s++as\b)?(?:\s*+" + _NO_ALIAS + NAME + r")?\s*+,?\s*+)++)"
)
WITH_NAME = (
    r"(?i)(?:\bwith\s++(?:recursive\s++)?|\)\s*+,\s*+)(" + NAME + r")\s*+(?:\([^()]*+\)\s*+)?as\s*+(?:(?:not\s++)?materialized\s*+)?\("
)
DECLARED_TABLE = (
    r"(?i)\bcreate\s++(?:(?:global|local|temp|temporary|external)\s++)*+table\s++(?:if\s++not\s++exists\s++)?(" + FULL_NAME + ")"
)
TABLE_BODY = r"(?is)\bcreate\b.*?\btable\b[^(]*\((.*)\)"
# Starts of parts of a table's body that declare no column.
NO_COLUMN = ["primary", "foreign", "unique", "check", "constraint", "key", "index", "exclude", "like"]

# One token of a query in group 1, which is empty for comments and blanks: a name with its qualifiers, quoted text, a number,
# an operator or any other character.
NAME_TOKEN = (
    r"--[^\r\n]*+|/\*[\s\S]*?\*/|\s++|(" + FULL_NAME + r"|(?:'[^']*+')++|\"[^\"]*+\"|[0-9][0-9A-Za-z_.]*+|<=|>=|<>|!=|==|\|\||[\s\S])"
)
# A text that is a query, after comments and brackets.
QUERY_START = r"(?is)^(?:\s|\(|--[^\r\n]*|/\*.*?\*/)*+(?:select|with)\b"
# Names that stand for a row's own number.
ROW_IDS = ["rowid", "oid", "_rowid_"]

# Clauses looked for as plain text in normalised SQL, with the class given when one is missing.
CLAUSE_CLASSES = [
    ("where", "missing_where"),
    ("join", "missing_join"),
    ("group by", "missing_groupby"),
    ("order by", "missing_orderby"),
]

# Start of a Spark error condition and the error class it means; the empty one fits any other.
RUN_ERRORS = [
    ("TABLE_OR_VIEW_NOT_FOUND", "wrong_table"),
    ("UNRESOLVED_COLUMN", "wrong_column"),
    ("", "runtime_error"),
]

# ---- fixed values: SQL keywords ---------------------------------------------------------------

# Words whose case does not count. Reserved words of the SQL standard and of SQLite, without type
# and function names. A caller can pass a longer list.
KEYWORDS = """
ABORT ACTION ADD AFTER ALL ALTER ANALYZE AND ANY AS ASC ATTACH AUTOINCREMENT BEFORE BEGIN BETWEEN
BY CASCADE CASE CAST CHECK COLLATE COLUMN COMMIT CONFLICT CONSTRAINT CREATE CROSS CURRENT
CURRENT_DATE CURRENT_TIME CURRENT_TIMESTAMP CURRENT_USER CURSOR DATABASE DEFAULT DEFERRABLE
DEFERRED DELETE DESC DESCRIBE DETACH DISTINCT DO DROP EACH ELSE END ESCAPE EXCEPT EXCLUSIVE
EXECUTE EXISTS EXPLAIN FALSE FETCH FILTER FIRST FOLLOWING FOR FOREIGN FROM FULL FUNCTION GLOB
GRANT GROUP GROUPING HAVING IF IGNORE ILIKE IMMEDIATE IN INDEX INITIALLY INNER INSERT INSTEAD
INTERSECT INTO IS ISNULL JOIN KEY LAST LATERAL LEFT LIKE LIMIT LOCAL LOOP MATCH MATERIALIZED MAX
MERGE MIN NATURAL NEXT NO NOT NOTHING NOTNULL NULL NULLS OF OFFSET ON OR ORDER OUTER OVER
PARTITION PLAN PRAGMA PRECEDING PRIMARY PROCEDURE RANGE RECURSIVE REFERENCES REGEXP REINDEX
RELEASE RENAME REPLACE RESTRICT RETURNING REVOKE RIGHT ROLLBACK ROLLUP ROW ROWS SAVEPOINT SELECT
SET SIMILAR SOME TABLE TEMP TEMPORARY THEN TO TRANSACTION TRIGGER TRUE TRUNCATE UNBOUNDED UNION
UNIQUE UNKNOWN UPDATE USING VACUUM VALUES VIEW VIRTUAL WHEN WHERE WHILE WINDOW WITH WITHOUT
""".split()

# Words that stay keywords when "(" follows at once; any other word there is a function name.
KEYWORDS_BEFORE_BRACKET = ["AS", "CASE", "FROM", "IN", "USING", "VALUES"]

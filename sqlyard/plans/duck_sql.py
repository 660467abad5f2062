"""DuckDB SQL for the queries of ``catalog``: written apart from the DataFrame code, to check it."""

from __future__ import annotations

import re

from sqlyard.functions import fixed
from sqlyard.plans.catalog import EXEC_PAIRS
from sqlyard.plans.derived import TEMPLATE_MODELS


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_BLANKS = _q(fixed.BLANKS)


def _strip(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def _stop(x: str) -> str:
    return f"(rtrim({_strip(x)}, ';') || ';')"


def _clean(x: str) -> str:
    opened = f"regexp_replace({_strip(x)}, {_q(fixed.OPENING_FENCE)}, '')"
    closing = f"{fixed.BLANK}*```{fixed.BLANK}*$"
    text = _strip(f"regexp_replace({opened}, {_q(closing)}, '')")
    text = _strip(f"split_part({text}, '###', 1)")
    text = _strip(f"split_part({text}, chr(10) || chr(10), 1)")
    return _strip(f"split_part({text}, ';', 1)")


def _norm(x: str) -> str:
    words = ", ".join(_q(w) for w in fixed.KEYWORDS + [w + "(" for w in fixed.KEYWORDS_BEFORE_BRACKET])
    comment = " OR ".join(f"starts_with(t, {_q(m)})" for m in fixed.COMMENT_STARTS)
    bare = _strip(f"rtrim({_strip(x)}, ';')")
    parts = f"""list_transform(regexp_extract_all({bare}, {_q(fixed.SQL_TOKEN)}), lambda t:
        CASE WHEN upper(t) IN ({words}) THEN lower(t) WHEN {comment} THEN ' ' ELSE t END)"""
    joined = f"coalesce(array_to_string({parts}, ''), '')"
    return _strip(f"regexp_replace({joined}, {_q(fixed.BLANK + '+')}, ' ', 'g')")


def _fill(template: str, question: str, schema: str, sql: str | None = None) -> str:
    values = {"{question}": _strip(question), "{schema}": _strip(schema), "{sql}": sql and _strip(sql)}
    pieces = [p for p in re.split(r"(\{\w+\})", template) if p]
    return "(" + " || ".join(values[p] if p in values else _q(p) for p in pieces) + ")"


def _prompt(template: str, question: str, schema: str) -> str:
    return _fill(fixed.TEMPLATES[template][0], question, schema)


def _text(template: str, question: str, schema: str, sql: str) -> str:
    return _fill("".join(fixed.TEMPLATES[template]), question, schema, sql)


def _round(x: str, places: int) -> str:
    scale = f"CAST({10 ** places} AS DOUBLE)"
    high = "(v * CAST(134217729 AS DOUBLE) - (v * CAST(134217729 AS DOUBLE) - v))"
    error = f"(({high} * {scale} - v * {scale}) + (v - {high}) * {scale})"
    tie = f"v * {scale} - floor(v * {scale}) = CAST(0.5 AS DOUBLE)"
    return f"""(list_transform([CAST({x} AS DOUBLE)], lambda v: CASE WHEN {tie} AND {error} < 0 THEN floor(v * {scale})
        WHEN {tie} AND {error} > 0 THEN ceil(v * {scale})
        ELSE CAST(round_even(v * {scale}, 0) AS DOUBLE) END / {scale})[1])"""


def _split(key: str) -> str:
    return f"CASE WHEN substr(md5('42|' || {key}), 1, 8) < '1999999a' THEN 'test' ELSE 'train' END"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# ---- derived tables ---------------------------------------------------------------------------

EX = """ex AS (
    SELECT o_orderkey AS ex_id, ' How many lines has order ' || o_orderkey || '? ' AS question,
        'CREATE TABLE lineitem (l_orderkey INT, l_linenumber INT, l_quantity REAL);' AS context,
        'SELECT COUNT(*) FROM lineitem WHERE l_orderkey = ' || o_orderkey
            || CASE WHEN o_orderkey % 3 = 0 THEN ';' ELSE '' END AS answer
    FROM orders)"""

NULLED = """nulled AS (
    SELECT ex_id, CASE WHEN ex_id % 5 <> 0 THEN question END AS question, CASE WHEN ex_id % 7 <> 0 THEN context END AS context,
        CASE WHEN ex_id % 11 <> 0 THEN answer END AS answer FROM ex)"""

KEYS = """keys AS (
    SELECT o_orderkey AS ex_id, model, (o_orderkey + shift) % 8 AS form
    FROM orders, (VALUES ('base', 0), ('tuned', 1)) m(model, shift))"""

PRED = KEYS + """, pred AS (
    SELECT ex_id, model, CASE form
        WHEN 0 THEN 'SELECT COUNT(*) FROM lineitem WHERE l_orderkey = ' || ex_id || ';'
        WHEN 1 THEN '```sql' || chr(10) || 'select COUNT(*)  from lineitem  where l_orderkey = ' || ex_id || ';'
            || chr(10) || '```'
        WHEN 2 THEN 'SELECT COUNT(*) FROM lineitem WHERE l_orderkey = ' || ex_id || ' AND l_orderkey = ' || ex_id
        WHEN 3 THEN 'SELECT COUNT(*) FROM lineitem'
        WHEN 4 THEN 'SELECT COUNT(*) FROM lineitems WHERE l_orderkey = ' || ex_id
        WHEN 5 THEN 'SELECT COUNT(*) FROM lineitem WHERE qty = ' || ex_id
        WHEN 6 THEN '  '
        ELSE 'SELECT SUM(l_quantity) FROM lineitem WHERE l_orderkey = ' || ex_id || ' ### Question: next' END AS raw_text
    FROM keys)"""

JOINED = f"""{EX}, {PRED}, cleaned AS (
    SELECT ex_id, model, {_clean('raw_text')} AS predicted_sql FROM pred
), joined AS (
    SELECT ex_id, model, question, context, answer AS gold_sql, predicted_sql,
        {_norm('predicted_sql')} AS pred_norm, {_norm('answer')} AS gold_norm
    FROM cleaned JOIN ex USING (ex_id))"""


def _bleu(source: str, keys: str) -> str:
    """CTEs that end in ``bleu_rows(keys, bleu)`` for ``source(keys, pred_norm, gold_norm)``."""
    on = " AND ".join(f"w.{k.strip()} = h.{k.strip()}" for k in keys.split(","))
    w_keys = ", ".join(f"w.{k.strip()}" for k in keys.split(","))
    side = "SELECT {keys}, '{s}' AS side, unnest({ws}) AS word, unnest(range(len({ws}))) AS i FROM words"
    gram = ", ".join(["word AS g1", *(
        "word" + "".join(f" || ' ' || lead(word, {j}) OVER ahead" for j in range(1, n)) + f" AS g{n}" for n in (2, 3, 4))])
    return f"""words AS MATERIALIZED (
    SELECT {keys}, CASE WHEN pred_norm = '' THEN [] ELSE string_split(pred_norm, ' ') END AS pw,
        CASE WHEN gold_norm = '' THEN [] ELSE string_split(gold_norm, ' ') END AS gw
    FROM {source}
), placed AS (
    {side.format(keys=keys, s='p', ws='pw')} UNION ALL {side.format(keys=keys, s='g', ws='gw')}
), runs AS (
    SELECT {keys}, side, {gram} FROM placed WINDOW ahead AS (PARTITION BY {keys}, side ORDER BY i)
), grams AS (
    {' UNION ALL '.join(f'SELECT {keys}, side, {n} AS n, g{n} AS gram FROM runs WHERE g{n} IS NOT NULL' for n in (1, 2, 3, 4))}
), counted AS (
    SELECT {keys}, n, gram, count(*) FILTER (side = 'p') AS cp, count(*) FILTER (side = 'g') AS cg
    FROM grams GROUP BY ALL
), hits AS (
    SELECT {keys},
        coalesce(sum(least(cp, cg)) FILTER (n = 1), 0) AS h1, coalesce(sum(least(cp, cg)) FILTER (n = 2), 0) AS h2,
        coalesce(sum(least(cp, cg)) FILTER (n = 3), 0) AS h3, coalesce(sum(least(cp, cg)) FILTER (n = 4), 0) AS h4
    FROM counted GROUP BY ALL
), bleu_rows AS (
    SELECT {w_keys}, CASE WHEN coalesce(h1, 0) = 0 THEN 0.0 ELSE exp(
        CASE WHEN len(pw) > len(gw) THEN 0 ELSE 1 - len(gw) / len(pw) END
        + (ln(h1 / len(pw))
        + ln(CASE WHEN h2 = 0 THEN 0.1 ELSE CAST(h2 AS DOUBLE) END / greatest(len(pw) - 1, 1))
        + ln(CASE WHEN h3 = 0 THEN 0.1 ELSE CAST(h3 AS DOUBLE) END / greatest(len(pw) - 2, 1))
        + ln(CASE WHEN h4 = 0 THEN 0.1 ELSE CAST(h4 AS DOUBLE) END / greatest(len(pw) - 3, 1))) / 4) END AS bleu
    FROM words w LEFT JOIN hits h ON {on})"""


EXEC = """captured AS (
    SELECT l_orderkey AS ex_id, m.model, m.side, CAST(l_linenumber AS VARCHAR) AS row_text,
        CASE WHEN model = 'tuned' AND side = 'pred' THEN
            CASE WHEN l_orderkey % 3 = 0 AND l_linenumber = 1 THEN 0 WHEN l_orderkey % 5 = 0 THEN 2 ELSE 1 END
        ELSE 1 END AS copies
    FROM lineitem, (VALUES ('base', 'gold'), ('base', 'pred'), ('tuned', 'gold'), ('tuned', 'pred')) m(model, side)
), text_counts AS (
    SELECT ex_id, model, row_text, coalesce(sum(copies) FILTER (side = 'pred'), 0) AS np,
        coalesce(sum(copies) FILTER (side = 'gold'), 0) AS ng
    FROM captured GROUP BY ALL
), verdicts AS (
    SELECT ex_id, model, bool_and(np = ng) AS eq FROM text_counts GROUP BY ALL
), executed AS (
    SELECT k.ex_id, k.model, form NOT IN (4, 5) AND coalesce(eq, true) AS result_equal
    FROM keys k LEFT JOIN verdicts v ON k.ex_id = v.ex_id AND k.model = v.model)"""

_RUN_ERROR = "CASE form WHEN 4 THEN 'wrong_table' WHEN 5 THEN 'wrong_column' END"


def _error_type(run_error: str) -> str:
    return f"""CASE
        WHEN pred_norm = gold_norm THEN NULL
        WHEN {_strip('predicted_sql')} = '' THEN 'syntax_error'
        WHEN {run_error} IS NOT NULL THEN {run_error}
        WHEN contains(gold_norm, 'where') AND NOT contains(pred_norm, 'where') THEN 'missing_where'
        WHEN contains(gold_norm, 'join') AND NOT contains(pred_norm, 'join') THEN 'missing_join'
        WHEN contains(gold_norm, 'group by') AND NOT contains(pred_norm, 'group by') THEN 'missing_groupby'
        WHEN contains(gold_norm, 'order by') AND NOT contains(pred_norm, 'order by') THEN 'missing_orderby'
        ELSE 'logic_error' END"""


CLASSED = f"""{JOINED}, classed AS (
    SELECT j.ex_id, j.model, {_error_type(_RUN_ERROR)} AS error_type
    FROM joined j JOIN keys USING (ex_id, model))"""

DISTRIBUTION = CLASSED + """, dist AS (
    SELECT model, error_type, count(*) AS n FROM classed WHERE error_type IS NOT NULL GROUP BY ALL)"""

SCORED = f"""{CLASSED}, {EXEC}, {_bleu('joined', 'ex_id, model')}, scored AS (
    SELECT j.ex_id, j.model, question, gold_sql, predicted_sql, pred_norm = gold_norm AS exact_match,
        {_strip('predicted_sql')} <> '' AS valid_sql, bleu,
        {_strip('predicted_sql')} <> '' AND result_equal AS execution_accuracy, error_type
    FROM joined j JOIN classed USING (ex_id, model) JOIN executed USING (ex_id, model)
        JOIN bleu_rows USING (ex_id, model))"""


def _rate(flag: str) -> str:
    return f"(count(*) FILTER ({flag}) / count(*) * 100)"


SUMMARY = SCORED + f""", summary AS (
    SELECT model, count(*) AS num_samples, {_round(_rate('exact_match'), 2)} AS exact_match_rate,
        {_round(_rate('valid_sql'), 2)} AS valid_sql_rate, {_round('avg(bleu)', 4)} AS avg_bleu,
        {_round(_rate('execution_accuracy'), 2)} AS execution_accuracy_rate
    FROM scored GROUP BY model)"""

LOG = "log AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS step, value AS eval_loss FROM events)"

WALK = """RECURSIVE """ + LOG + """, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS rn FROM log
), walk AS (
    SELECT run_id, rn, step, eval_loss, eval_loss AS best, 0 AS wait, false AS stopped,
        eval_loss AS low, step AS low_step
    FROM ranked WHERE rn = 1
    UNION ALL
    SELECT w.run_id, r.rn, r.step, r.eval_loss,
        CASE WHEN r.eval_loss < w.best - 0.001::DOUBLE THEN r.eval_loss ELSE w.best END,
        CASE WHEN r.eval_loss < w.best - 0.001::DOUBLE THEN 0 ELSE w.wait + 1 END,
        CASE WHEN r.eval_loss < w.best - 0.001::DOUBLE THEN false ELSE w.wait + 1 >= 5 END,
        least(w.low, r.eval_loss),
        CASE WHEN r.eval_loss < w.low THEN r.step ELSE w.low_step END
    FROM walk w JOIN ranked r ON r.run_id = w.run_id AND r.rn = w.rn + 1 WHERE NOT w.stopped
), ends AS (
    SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY rn DESC) = 1)"""

BEST = LOG + """, best AS (
    SELECT run_id, step AS best_step, eval_loss AS best_loss FROM log
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) = 1)"""


def _describe(source: str, columns: dict[str, str]) -> str:
    parts = [
        f"""SELECT {_q(name)} AS metric, CAST(count({x}) AS BIGINT) AS count, {_round(f'avg({x})', 0)} AS mean,
        {_round(f'stddev_samp({x})', 0)} AS std, {_round(f'min({x})', 0)} AS min,
        {_round(f'quantile_cont({x}, 0.25)', 0)} AS p25, {_round(f'quantile_cont({x}, 0.5)', 0)} AS p50,
        {_round(f'quantile_cont({x}, 0.75)', 0)} AS p75, {_round(f'max({x})', 0)} AS max
        FROM {source}"""
        for name, x in columns.items()
    ]
    return "\nUNION ALL\n".join(parts)


def _histogram(source: str, columns: dict[str, str]) -> str:
    """Compares every value with all 60 edges; the query under test computes the bin instead."""
    values = " UNION ALL ".join(
        f"SELECT {_q(name)} AS metric, CAST({x} AS DOUBLE) AS v FROM {source}" for name, x in columns.items()
    )
    return f"""vals AS ({values}), ends AS (
    SELECT metric, CASE WHEN min(v) = max(v) THEN min(v) - 0.5::DOUBLE ELSE min(v) END AS lo,
        CASE WHEN min(v) = max(v) THEN max(v) + 0.5::DOUBLE ELSE max(v) END AS hi FROM vals GROUP BY metric
), edges AS (
    SELECT metric, b AS bin, b * ((hi - lo) / 60::DOUBLE) + lo AS bin_from,
        CASE WHEN b = 59 THEN hi ELSE (b + 1) * ((hi - lo) / 60::DOUBLE) + lo END AS bin_to
    FROM ends, range(60) r(b)
)
SELECT e.metric, CAST(bin AS BIGINT) AS bin, bin_from, bin_to, count(*) AS n FROM vals v JOIN edges e
    ON v.metric = e.metric AND v.v >= bin_from AND (v.v < bin_to OR (bin = 59 AND v.v = bin_to))
GROUP BY ALL"""


_LENGTHS = {"q_len": "length(question)", "sql_len": "length(answer)", "schema_len": "length(context)"}


def _prepared(template: str, split: bool) -> str:
    return _with(EX) + f"""SELECT ex_id, {_text(template, 'question', 'context', _stop('answer'))} AS "text",
    {_prompt(template, 'question', 'context')} AS prompt, {_stop('answer')} AS completion, question,
    context AS "schema", answer AS gold_sql{', ' + _split('ex_id') + ' AS split' if split else ''} FROM ex"""


def _by_model(render) -> str:
    """The template of each model name, spelled out by name."""
    kinds = ["generic", "mistral-instruct", "llama3-chat", "chatml", "chatml", "generic"]
    cases = " ".join(f"WHEN {_q(m)} THEN {render(t)}" for m, t in zip(TEMPLATE_MODELS, kinds))
    return f"CASE model_name {cases} END"


_MODEL_ROWS = "(VALUES " + ", ".join(f"({_q(m)})" for m in TEMPLATE_MODELS) + ") m(model_name)"

_GENERIC_TEXT = _text("generic", "question", "context", _stop("answer"))

_FIRST_EXAMPLE = "(SELECT * FROM ex ORDER BY ex_id LIMIT 1)"


def _exec_pairs() -> str:
    rows = []
    failing = {6: "'wrong_table'", 7: "'wrong_column'"} | dict.fromkeys((8, 9, 10, 14), "'runtime_error'")
    for i, (gold, pred) in enumerate(EXEC_PAIRS):
        error = failing.get(i, "NULL")
        gold, pred = gold.rstrip(";"), pred.rstrip(";")
        if error != "NULL":
            equal = "false"
        elif i == 1:
            equal = "false"  # columns swapped: (text, number) against (number, text)
        else:
            equal = (
                f"(SELECT count(*) = 0 FROM ((({gold}\n) EXCEPT ALL ({pred}\n)) UNION ALL (({pred}\n) EXCEPT ALL ({gold}\n))))"
            )
        rows.append(f"SELECT CAST({i} AS BIGINT) AS ex_id, 'model' AS model, {equal} AS result_equal, "
                    f"CAST({error} AS VARCHAR) AS run_error")
    return "\nUNION ALL\n".join(rows)


_STATUS = f"""CASE WHEN ex_id % 7 = 0 THEN {_q(fixed.STATUS_NO_QUESTION)}
    WHEN ex_id % 11 = 0 THEN {_q(fixed.STATUS_NO_SCHEMA)} END"""


def _two(column: str, as_name: str) -> str:
    return ", ".join(
        f"max({column}) FILTER (model = {_q(m)}) AS {side}_{as_name}"
        for side, m in (("base", "base"), ("finetuned", "tuned"))
    )


_COMPARISON = f"""SELECT ex_id, max(question) AS question, max(gold_sql) AS gold_sql,
    {_two('predicted_sql', 'prediction')}, {_two('exact_match', 'exact_match')},
    {_two(_round('bleu', 4), 'bleu')}, {_two('execution_accuracy', 'exec_accuracy')}
    FROM scored GROUP BY ex_id"""

_SIDE_BY_SIDE = f"""SELECT 'base' AS base_model, 'tuned' AS finetuned_model, max(num_samples) AS num_samples,
    {_two('exact_match_rate', 'exact_match')}, {_two('valid_sql_rate', 'valid_sql_rate')},
    {_two('avg_bleu', 'avg_bleu')}, {_two('execution_accuracy_rate', 'execution_accuracy')} FROM summary"""

_COUNTED = f"""{EX}, answers AS (
    SELECT ex_id, 'counting' AS model, answer AS gold_sql,
        'SELECT COUNT(*) FROM lineitem' || CASE WHEN ex_id % 2 = 0 THEN ' WHERE l_orderkey = ' || ex_id ELSE '' END AS predicted_sql
    FROM ex WHERE {_split('ex_id')} = 'test'
), judged AS (
    SELECT ex_id, model, {_norm('predicted_sql')} AS pred_norm, {_norm('gold_sql')} AS gold_norm FROM answers)"""

# (class by captured error, class by schema) of each query form
FORM_CLASSES = [
    (None, None), ("syntax_error", "syntax_error"), ("wrong_table", "wrong_table"), ("wrong_column", "wrong_column"), ("wrong_column", "wrong_column"),
    ("runtime_error", "logic_error"), ("missing_where", "missing_where"), ("missing_join", "missing_join"), ("wrong_column", "wrong_column"),
    ("logic_error", "logic_error"), ("missing_groupby", "missing_groupby"), ("missing_orderby", "missing_orderby"), ("wrong_column", "wrong_column"),
    ("logic_error", "logic_error"), ("logic_error", "logic_error"), ("wrong_column", "wrong_column"),
]


def _by_form(values: list[tuple], place: int) -> str:
    cases = " ".join(f"WHEN {i} THEN {_q(v[place])}" for i, v in enumerate(values) if v[place] is not None)
    return f"CASE o_orderkey % {len(values)} {cases} END"


QUERIES: dict[str, str] = {
    "prepare_examples": _prepared("generic", True),
    "prepare_instruct": _prepared("mistral-instruct", False),
    "text_only": _with(EX) + f"""SELECT ex_id, {_text('generic', 'question', 'context', 'answer')} AS "text" FROM ex""",
    "prompt_by_model": _with(EX) + f"""SELECT ex_id, model_name,
        {_by_model(lambda t: _prompt(t, 'question', 'context'))} AS prompt,
        {_by_model(lambda t: _text(t, 'question', 'context', 'answer'))} AS "text" FROM ex, {_MODEL_ROWS}""",
    "template_preview": _with(EX) + " UNION ALL ".join(
        f"""SELECT ex_id, {_q(t)} AS template, {_text(t, 'question', 'context', 'answer')} AS "text" FROM ex"""
        for t in fixed.TEMPLATES
    ),
    "preview_row": _with(EX) + " UNION ALL ".join(
        f"SELECT {_q(c)} AS field, left(CAST({c} AS VARCHAR), 200) AS value FROM {_FIRST_EXAMPLE}"
        for c in ("ex_id", "question", "context", "answer")
    ),
    "preview_prompt": _with(EX) + f"SELECT left({_GENERIC_TEXT}, 600) AS preview FROM {_FIRST_EXAMPLE}",
    "split_counts": f"""SELECT source, split, count(*) AS n_rows FROM (
        SELECT 'examples' AS source, {_split('o_orderkey')} AS split FROM orders
        UNION ALL SELECT 'documents', {_split('doc_id')} FROM documents) GROUP BY ALL""",
    "exact_split_counts": """SELECT split, count(*) AS n_rows FROM (
        SELECT CASE WHEN row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) <= ceil(count(*) OVER () * 0.1)
            THEN 'test' ELSE 'train' END AS split FROM documents) GROUP BY split""",
    "capped_split": _with(EX) + f"""SELECT ex_id, split, question FROM (
        SELECT ex_id, question, {_split('ex_id')} AS split FROM ex)
        QUALIFY row_number() OVER (PARTITION BY split ORDER BY md5('42|' || ex_id), ex_id)
            <= CASE split WHEN 'train' THEN 2000 ELSE 200 END""",
    "first_examples": _with(EX) + "SELECT * FROM ex ORDER BY ex_id LIMIT 500",
    "first_many_examples": _with(EX) + "SELECT * FROM ex ORDER BY ex_id LIMIT 5000",
    "random_sample_k": "SELECT * FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 5",
    "clean_predictions": _with(PRED) + f"SELECT ex_id, model, {_clean('raw_text')} AS predicted_sql FROM pred",
    "clean_documents": f"""SELECT doc_id, {_clean('"text"')} AS cleaned FROM documents""",
    "normalize_sql": _with(PRED) + f"SELECT ex_id, model, {_norm('raw_text')} AS norm FROM pred",
    "normalize_documents": f"""SELECT doc_id, {_norm('"text"')} AS norm FROM documents""",
    # the statements, written out
    "ddl_statements": _with(EX) + """SELECT ex_id, CAST(pos AS INTEGER) AS pos, CASE pos WHEN 0 THEN context
        WHEN 1 THEN 'CREATE TABLE notes (id INT, mark TEXT DEFAULT ''a;b'', k INT DEFAULT ' || ex_id || ');' WHEN 2 THEN ';'
        WHEN 3 THEN 'CREATE TRIGGER t AFTER INSERT ON notes BEGIN UPDATE notes SET k = CASE WHEN k > 1 THEN 0 ELSE 1 END;' || chr(10)
            || 'DELETE FROM notes;' || chr(10) || 'END;'
        ELSE 'DROP TABLE x' END AS statement FROM ex, range(5) r(pos)""",
    # what each form lacks follows from its number
    "missing_tables": _with(KEYS) + "SELECT ex_id, model, 'lineitems' AS table_name FROM keys WHERE form = 4",
    "exact_match": _with(JOINED) + "SELECT ex_id, model, pred_norm = gold_norm AS exact_match FROM joined",
    "loose_match": _with(JOINED) + f"""SELECT ex_id, model,
        lower({_strip('predicted_sql')}) = lower({_strip('gold_sql')}) AS loose_match FROM joined""",
    "bleu": _with(JOINED, _bleu("joined", "ex_id, model"))
        + f"SELECT ex_id, model, {_round('bleu', 6)} AS bleu FROM bleu_rows",
    "bleu_text": _with(
        f"""items AS MATERIALIZED (SELECT {_norm('"text"')} AS gold_norm, row_number() OVER (ORDER BY item_id) - 1 AS place FROM benchmark)""",
        f"""pairs AS MATERIALIZED (SELECT doc_id, {_norm('"text"')} AS pred_norm, gold_norm
        FROM documents JOIN items ON place = doc_id % (SELECT count(*) FROM benchmark))""",
        _bleu("pairs", "doc_id"),
    ) + f"SELECT doc_id, {_round('bleu', 6)} AS bleu FROM bleu_rows",
    "result_equality": _with(KEYS, EXEC) + "SELECT ex_id, model, result_equal FROM executed",
    "same_rows": """WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
            WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')),
        b AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE o_orderpriority = '1-URGENT')
        SELECT count(*) = 0 AS result_equal FROM (
            (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""",
    "error_class": _with(CLASSED) + "SELECT ex_id, model, error_type FROM classed",
    "error_class_by_schema": _with(CLASSED) + "SELECT ex_id, model, error_type FROM classed",
    # the class of each form, written out
    "error_class_forms": f"""SELECT o_orderkey AS ex_id, {_by_form(FORM_CLASSES, 0)} AS by_run, {_by_form(FORM_CLASSES, 1)} AS by_schema
        FROM orders""",
    "error_distribution": _with(DISTRIBUTION) + """SELECT model, error_type, n,
        CAST(row_number() OVER (PARTITION BY model ORDER BY n DESC, error_type) AS INTEGER) AS error_rank FROM dist""",
    "error_share": _with(DISTRIBUTION) + f"""SELECT model, error_type, n,
        {_round('n / sum(n) OVER (PARTITION BY model) * 100', 2)} AS share_pct FROM dist""",
    "result_records": _with(SCORED) + f"SELECT * REPLACE ({_round('bleu', 4)} AS bleu) FROM scored",
    "eval_summary": _with(SUMMARY) + "SELECT * FROM summary",
    "comparison_records": _with(SCORED) + _COMPARISON,
    "sample_predictions": _with(SCORED) + f"""SELECT ex_id, question, gold_sql, base_prediction, finetuned_prediction
        FROM ({_COMPARISON}) ORDER BY ex_id LIMIT 5""",
    "comparison_readback": _with(SCORED) + _COMPARISON,
    "summary_by_batches": _with(SUMMARY) + "SELECT * FROM summary",
    "prediction_samples": _with(SCORED) + f"""SELECT ex_id, model, left(question, 220) AS question, left(predicted_sql, 220) AS prediction,
        CASE WHEN exact_match THEN 'exact' WHEN execution_accuracy THEN 'same result' ELSE 'wrong' END AS verdict,
        {_round('bleu', 4)} AS bleu, coalesce(error_type, '') AS error_type FROM scored""",
    "uneven_comparison": _with(SUMMARY.replace("FROM scored GROUP BY model", "FROM scored WHERE ex_id % 3 <> 0 GROUP BY model")) + _SIDE_BY_SIDE,
    "model_comparison": _with(SUMMARY) + _SIDE_BY_SIDE,
    "metric_delta": _with(SCORED) + f"""SELECT metric, {_round('b', 1)} AS base_value, {_round('t', 1)} AS tuned_value,
        {_round('d', 1)} AS delta,
        CASE WHEN d >= 0 THEN '+' ELSE '' END || printf('%.1f', {_round('d', 1)}) || '%' AS delta_text
        FROM (SELECT *, {_round('t - b', 9)} + CAST(0 AS DOUBLE) AS d FROM (SELECT metric, max(v) FILTER (model = 'base') AS b, max(v) FILTER (model = 'tuned') AS t FROM (
            SELECT model, 'exact_match' AS metric, {_rate('exact_match')} AS v FROM scored GROUP BY model
            UNION ALL SELECT model, 'valid_sql', {_rate('valid_sql')} FROM scored GROUP BY model
            UNION ALL SELECT model, 'bleu', avg(bleu) * 100 FROM scored GROUP BY model
            UNION ALL SELECT model, 'execution_accuracy', {_rate('execution_accuracy')} FROM scored GROUP BY model
        ) GROUP BY metric))""",
    "length_profile": _describe("documents", {"text_len": 'length("text")'}),
    "example_length_profile": _with(EX) + _describe("ex", _LENGTHS),
    "length_histogram": "WITH " + _histogram("documents", {"text_len": 'length("text")'}),
    "example_length_histogram": "WITH " + EX + ", " + _histogram("ex", _LENGTHS),
    "plateau": "WITH " + WALK + """ SELECT run_id, best AS best_loss, CAST(wait AS INTEGER) AS wait,
        CASE WHEN stopped THEN step END AS stop_step, stopped, low AS low_loss, low_step, rn AS n_evals,
        step AS last_step FROM ends""",
    "plateau_stream": "WITH " + WALK + """ SELECT run_id, step, eval_loss, best AS best_loss,
        CAST(wait AS INTEGER) AS wait, stopped FROM walk""",
    "exact_match_stream": f"""SELECT doc_id, {_norm(_clean('"text"'))} = {_norm('"text"')} AS exact_match FROM documents""",
    "best_checkpoint": "WITH " + BEST + " SELECT run_id, best_step, best_loss FROM best",
    "retained_checkpoints": "WITH " + BEST + """ SELECT run_id, step, eval_loss, step = best_step AS is_best,
        CAST(row_number() OVER (PARTITION BY run_id ORDER BY (step = best_step) DESC, step DESC) AS INTEGER) AS keep_rank
        FROM log JOIN best USING (run_id) QUALIFY keep_rank <= 3""",
    "run_summary": "WITH " + WALK + """ SELECT run_id, low AS best_eval_loss, low_step AS best_step,
        step AS last_step, rn AS n_evals, stopped AS early_stopped FROM ends""",
    "run_history": "WITH " + BEST + """ SELECT CAST(run_id AS BIGINT) AS run_no, best_loss, best_step,
        best_loss - lag(best_loss) OVER (ORDER BY CAST(run_id AS BIGINT)) AS best_loss_change FROM best""",
    "request_status": _with(EX) + f"SELECT ex_id, {_STATUS} AS status FROM ex",
    "answer_requests": _with(EX) + f"""SELECT ex_id,
        CASE WHEN {_STATUS} IS NULL THEN 'SELECT COUNT(*) FROM lineitem' ELSE '' END AS sql,
        coalesce({_STATUS}, {_q(fixed.STATUS_OK)}) AS status FROM ex""",
    "score_batch": _with(EX) + f"""SELECT ex_id, {_q(TEMPLATE_MODELS[0])} AS model, 'SELECT COUNT(*) FROM '
        || regexp_extract(context, 'CREATE TABLE ([^ ]+)', 1) AS predicted_sql FROM ex""",
    "score_budget": _with(EX) + f"""SELECT ex_id, {_q(TEMPLATE_MODELS[0])} AS model,
        CASE WHEN ex_id % 10 = 7 THEN '' ELSE 'SELECT COUNT(*) FROM lineitem'
            || CASE WHEN ex_id % 2 = 0 THEN ' WHERE l_orderkey = ' || ex_id ELSE '' END END AS predicted_sql,
        CASE WHEN ex_id % 10 = 7 THEN '0 answers to 1 prompts' END AS error FROM ex""",
    "end_to_end": _with(_COUNTED, _bleu("judged", "ex_id, model")) + f"""SELECT j.model, count(*) AS num_samples,
        {_round("count(*) FILTER (ex_id % 2 = 0) / count(*) * 100", 2)} AS exact_match_rate, CAST(100 AS DOUBLE) AS valid_sql_rate,
        {_round('avg(bleu)', 4)} AS avg_bleu, 'missing_where' AS error_type, count(*) FILTER (ex_id % 2 = 1) AS n
        FROM judged j JOIN bleu_rows USING (ex_id, model) GROUP BY j.model""",
    "score_models": _with(EX) + f"""SELECT ex_id, model, 'SELECT COUNT(*) FROM '
        || regexp_extract(context, 'CREATE TABLE ([^ ]+)', 1) AS predicted_sql
        FROM ex, (VALUES ({_q(TEMPLATE_MODELS[0])}), ({_q(TEMPLATE_MODELS[1])})) m(model)""",
    "jsonl_roundtrip": _prepared("generic", True),
    "jsonl_quarantine": """SELECT 'read' AS kind, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE o_orderkey % 9 NOT IN (1, 2, 3, 4)
        UNION ALL SELECT 'rejected', count(*), count(*) FROM orders WHERE o_orderkey % 9 IN (1, 2, 3)""",
    "report_readback": _with(DISTRIBUTION) + "SELECT model, error_type, n FROM dist",
    "report_recount": _with(CLASSED) + """SELECT model, coalesce(error_type, 'unknown') AS error_type,
        count(*) AS n FROM classed GROUP BY ALL""",
    "exec_pairs": _exec_pairs(),
    "read_examples_parquet": _with(EX, NULLED) + "SELECT * FROM nulled",
    "read_examples_json": _with(EX, NULLED) + "SELECT * FROM nulled",
    "prepare_null_fields": _with(EX, NULLED) + f"""SELECT ex_id, {_prompt("generic", "coalesce(question, '')", "coalesce(context, '')")} AS prompt,
        {_stop("coalesce(answer, '')")} AS completion, coalesce(question, '') AS question, coalesce(context, '') AS schema,
        coalesce(answer, '') AS gold_sql FROM nulled""",
    "row_at": _with(EX) + "SELECT * FROM ex WHERE ex_id = 7",
    "missing_input": "SELECT count(*) AS n_rows, true AS names_path FROM orders",
    "exact_match_own_keywords": _with(KEYS) + "SELECT ex_id, model, form IN (0, 1) AS exact_match FROM keys",
}
QUERIES["comparison_summary_readback"] = QUERIES["model_comparison"]

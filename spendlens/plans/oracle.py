"""Equivalent SQL (DuckDB dialect) for every oracle-checkable query.

These strings are the independent check of the Spark plans: they read the same parquet
tables through an engine that shares no code with Spark. Each builder returns a
SELECT whose column names match the Spark query of the same key.
"""

from __future__ import annotations

# Patterns are written out here on their own: runs of white space, and word tokens.
SPACES = "[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F}\\x{85}\\p{Z}]"
TOKEN = "[\\p{L}\\p{N}_]{2,}"

VIEW_D = (
    "SELECT doc_id AS row_id, source AS vendor_id, "
    "split_part(text, chr(10), 1) AS item_name, "
    "CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1) "
    "WHEN text IS NOT NULL THEN '' END AS item_description, "
    "lang || '-' || source AS account_name, "
    "CAST(n_chars AS DOUBLE) AS item_total_amount FROM documents"
)

VIEW_L = (
    "SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
    "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
    "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS row_id, "
    "CAST(l_suppkey AS VARCHAR) AS vendor_id, p_name AS item_name, "
    "p_type || ' ' || p_brand AS item_description, p_brand || '/' || p_type AS account_name, "
    "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS item_total_amount "
    "FROM lineitem JOIN part ON l_partkey = p_partkey"
)


def view(name: str) -> str:
    return {"D": VIEW_D, "L": VIEW_L}[name.upper()]


def norm(x: str) -> str:
    return (f"trim(regexp_replace(lower(coalesce(CAST({x} AS VARCHAR), '')), "
            f"'{SPACES}+', ' ', 'g'))")


def blank(x: str) -> str:
    return f"regexp_full_match(coalesce({x}, ''), '{SPACES}*')"


AMOUNT = ("CASE WHEN item_total_amount IS NULL OR isnan(item_total_amount) THEN 0.0 "
          "ELSE item_total_amount END")


def clean(view_name: str = "D") -> str:
    return (
        "SELECT row_id, coalesce(vendor_id, '') AS vendor_id, coalesce(item_name, '') AS item_name, "
        "coalesce(item_description, '') AS item_description, account_name, "
        f"{AMOUNT} AS item_total_amount, {norm('item_name')} AS item_key, "
        f"trim({norm('item_name')} || ' ' || {norm('item_description')}) AS text, "
        f"ln(1 + abs({AMOUNT})) AS amount_log "
        f"FROM ({view(view_name)}) v WHERE account_name IS NOT NULL"
    )


def md5_key(seed, *cols: str) -> str:
    parts = " || ':' || ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"md5({parts})"


def hex7(expr: str) -> str:
    return f"CAST(('0x' || substr({expr}, 1, 7)) AS BIGINT)"


def with_random_split(view_name: str = "D", seed: int = 42, fraction: float = 0.2) -> str:
    """CTE body: cleaned rows with a ``split`` column (SPL-1)."""
    return (
        f"SELECT c.*, CASE WHEN row_number() OVER (ORDER BY {md5_key(seed, 'row_id')}) "
        f"<= ceil({fraction} * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split "
        f"FROM ({clean(view_name)}) c"
    )


def with_group_split(view_name: str = "D", seed: int = 42, fraction: float = 0.2) -> str:
    """CTE body: cleaned rows with a ``split`` column (SPL-2, whole item groups)."""
    return (
        f"SELECT c.*, CASE WHEN g.is_test THEN 'test' ELSE 'train' END AS split "
        f"FROM ({clean(view_name)}) c JOIN ("
        f"  SELECT item_key, row_number() OVER (ORDER BY {md5_key(seed, 'item_key')}) "
        f"  <= ceil({fraction} * count(*) OVER ()) AS is_test "
        f"  FROM (SELECT DISTINCT item_key FROM ({clean(view_name)}) x) gg) g USING (item_key)"
    )


def majority(src: str, key: str, out: str) -> str:
    """Majority label per key; ties -> smallest label."""
    return (
        f"SELECT {key}, {out} FROM (SELECT {key}, account_name AS {out}, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY n DESC, account_name) AS rn FROM "
        f"(SELECT {key}, account_name, count(*) AS n FROM {src} GROUP BY ALL) v) r WHERE rn = 1"
    )


def lookup_predictions(split_cte: str, pfx: str = "") -> str:
    """CTE chain of baseline predictions over ``split_cte`` ending in ``{pfx}p`` (test rows)."""
    x = pfx
    return (
        f"WITH {x}s AS ({split_cte}), {x}tr AS (SELECT * FROM {x}s WHERE split = 'train'), "
        f"{x}te AS (SELECT * FROM {x}s WHERE split = 'test'), "
        f"{x}im AS ({majority(x + 'tr', 'item_key', 'item_label')}), "
        f"{x}vm AS ({majority(x + 'tr', 'vendor_id', 'vendor_label')}), "
        f"{x}gm AS (SELECT account_name AS g FROM {x}tr GROUP BY account_name "
        f"       ORDER BY count(*) DESC, account_name LIMIT 1), "
        f"{x}p AS (SELECT {x}te.row_id, {x}te.account_name, {x}te.item_key, {x}te.vendor_id, "
        f"      coalesce(nullif({x}im.item_label, ''), nullif({x}vm.vendor_label, ''), (SELECT g FROM {x}gm)) "
        f"      AS predicted FROM {x}te LEFT JOIN {x}im USING (item_key) LEFT JOIN {x}vm USING (vendor_id)) "
    )


def report(pred: str, by: str = "", pfx: str = "") -> str:
    """CTE text: per-label report ``{pfx}rep`` over prediction relation ``pred``
    (columns account_name, predicted [, by])."""
    b = f"{by}, " if by else ""
    return (
        f"{pfx}pairs AS (SELECT {b}account_name AS t, predicted AS p, count(*) AS n FROM {pred} GROUP BY ALL), "
        f"{pfx}lab AS (SELECT {b}label, CAST(sum(support) AS DOUBLE) AS support, "
        f"CAST(sum(pn) AS DOUBLE) AS pn, CAST(sum(tp) AS DOUBLE) AS tp FROM ("
        f"  SELECT {b}t AS label, n AS support, 0 AS pn, CASE WHEN t = p THEN n ELSE 0 END AS tp FROM {pfx}pairs "
        f"  UNION ALL SELECT {b}p AS label, 0 AS support, n AS pn, 0 AS tp FROM {pfx}pairs) u GROUP BY ALL), "
        f"{pfx}rep AS (SELECT {b}label, CASE WHEN pn > 0 THEN tp / pn ELSE 0.0 END AS precision, "
        f"CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, "
        f"CASE WHEN support + pn > 0 THEN 2 * tp / (support + pn) ELSE 0.0 END AS f1, "
        f"CAST(support AS BIGINT) AS support FROM {pfx}lab) "
    )


def lookup_eval(split_cte: str, pfx: str, key: str) -> str:
    """CTE chain (without WITH) ending in ``{pfx}ev`` = (key, accuracy, macro_f1)."""
    body = lookup_predictions(split_cte, pfx).removeprefix("WITH ").rstrip()
    return (body + ", " + report(f"{pfx}p", pfx=pfx)
            + f", {pfx}ev AS (SELECT '{key}' AS key, (SELECT avg(CAST(account_name = predicted AS DOUBLE)) "
              f"FROM {pfx}p) AS accuracy, (SELECT avg(f1) FROM {pfx}rep) AS macro_f1)")


def word_terms(col: str, bigrams: bool = True) -> str:
    tok = f"regexp_extract_all(strip_accents({col}), '{TOKEN}')"
    if not bigrams:
        return tok
    # The token list is bound once, as the parameter of a lambda over a one-element list.
    return (f"list_transform([{tok}], lambda tk: list_concat(tk, list_transform(range(1, len(tk)), "
            f"lambda i: tk[i] || ' ' || tk[i + 1])))[1]")


def char_terms(col: str) -> str:
    return (f"flatten(list_transform(list_filter(string_split({col}, ' '), lambda w: length(w) > 0), "
            f"lambda w: flatten(list_transform(range(3, least(5, length(w) + 2) + 1), "
            f"lambda n: list_transform(range(1, length(w) + 2 - n + 2), "
            f"lambda i: substr(' ' || w || ' ', i, n))))))")


def term_counts(src: str, terms_expr: str) -> str:
    return (f"SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest({terms_expr}) AS term "
            f"FROM {src}) x GROUP BY ALL")


def tfidf(train_src: str, apply_src: str, terms_expr: str, min_df: int) -> str:
    """CTE text ending in ``tw`` = (row_id, term, weight)."""
    return (
        f"tctr AS ({term_counts(train_src, terms_expr)}), "
        f"tcap AS ({term_counts(apply_src, terms_expr)}), "
        f"voc AS (SELECT term, count(*) AS df FROM tctr GROUP BY 1 HAVING count(*) >= {min_df}), "
        f"idf AS (SELECT term, df, ln((nd + 1) / (df + 1)) + 1 AS idf FROM voc, "
        f"        (SELECT CAST(count(*) AS DOUBLE) AS nd FROM {train_src}) n), "
        f"raw AS (SELECT row_id, term, (1 + ln(tf)) * idf AS w FROM tcap JOIN idf USING (term)), "
        f"tw AS (SELECT row_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS weight FROM raw) "
    )


QUANTILE_LIST = "[" + ", ".join(f"{i / 10}::DOUBLE" for i in range(11)) + "]"

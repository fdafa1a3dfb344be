"""Table jobs built from the reference's scalar helpers (Q1-Q5).

Each job is one pass over a whole table with native column expressions.
The DuckDB oracles restate the same rules with RE2 / DuckDB functions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from uvlens.functions import jsonx as JX
from uvlens.functions import keys as K
from uvlens.functions import text as TX
from uvlens.plans.registry import register
from uvlens.sources.tables import read_table

# --- Q1 profile_text_rules ---------------------------------------------------------

PROFILED = {
    "documents": {"text": "text", "lang": "lang", "source": "source"},
    "customer": {"c_name": "c_name", "c_mktsegment": "c_mktsegment",
                 "acctbal_text": "format_string('%.2f', c_acctbal)"},
    "events": {"props": "props", "event_type": "event_type",
               "value_text": "format_string('%.2f', value)"},
    "conversations": {"role": "role", "text": "text"},
}
DUCK_COLS = {
    "format_string('%.2f', c_acctbal)": "printf('%.2f', c_acctbal)",
    "format_string('%.2f', value)": "printf('%.2f', value)",
}


def _duck_rule(rule: str, c: str) -> str:
    def m(p):
        return f"coalesce(regexp_matches({c}, '{TX.full(p)}'), false)"
    special = {
        "is_empty": f"coalesce(regexp_matches({c}, '^{TX.JAVA_BLANK}*\\z'), true)",
        "is_not_empty": f"NOT coalesce(regexp_matches({c}, '^{TX.JAVA_BLANK}*\\z'), true)",
        "is_number": f"({m(TX.NUMBER)} AND length({c}) > 0)",
        "has_special_char": f"coalesce(regexp_matches({c}, '{TX.SPECIAL_CHARS}'), false)",
    }
    if rule in special:
        return special[rule]
    pat = {"is_phone": TX.PHONE, "is_date": TX.DATE, "is_double": TX.DOUBLE, "is_int": TX.INT,
           "is_scientific": TX.SCIENTIFIC, "is_digits": TX.DIGITS, "is_letter": TX.LETTER,
           "is_letter_or_numeric": TX.LETTER_OR_NUMERIC,
           "is_letter_num_underline": TX.LETTER_NUM_UNDERLINE, "is_email": TX.EMAIL,
           "is_md5": TX.MD5}[rule]
    return m(pat)


def _profile_sql() -> str:
    parts = []
    for table, cols in PROFILED.items():
        for name, expr in cols.items():
            dexpr = DUCK_COLS.get(expr, expr)
            for rule in TX.RULES:
                parts.append(f"SELECT '{table}' AS table_name, '{name}' AS column_name, "
                             f"'{rule}' AS rule, (count(*) FILTER (WHERE {_duck_rule(rule, dexpr)}))"
                             f"::BIGINT AS n_pass, count(*)::BIGINT AS n_rows FROM {table}")
    return "\nUNION ALL\n".join(parts)


@register("profile_text_rules", _profile_sql())
def profile_text_rules(spark, sf_dir):
    """Q1: per table, column and rule, how many rows pass (one scan per table,
    one global aggregate with partial sums per task)."""
    out = None
    for table, cols in PROFILED.items():
        df = read_table(spark, sf_dir, table)
        flags = []
        for name, expr in cols.items():
            col = F.expr(expr)
            for rule, fn in TX.RULES.items():
                flags.append(F.sum(fn(col).cast("int")).cast("bigint").alias(f"{name}|{rule}"))
        agg = df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), *flags)
        long = agg.unpivot(["n_rows"], [c for c in agg.columns if c != "n_rows"], "key", "n_pass")
        long = long.select(F.lit(table).alias("table_name"),
                           F.split_part("key", F.lit("|"), F.lit(1)).alias("column_name"),
                           F.split_part("key", F.lit("|"), F.lit(2)).alias("rule"),
                           "n_pass", "n_rows")
        out = long if out is None else out.unionByName(long)
    return out


# --- Q2 derive_text_columns -----------------------------------------------------------

# Fixed values for the template replacement job.
TOKEN_MAP = {"the": "a", "and": "or", "of": "off"}


def _d_nonempty(value: str) -> str:
    return f"CASE WHEN text IS NULL OR length(text) = 0 THEN NULL ELSE {value} END"


def _d_flag(value: str) -> str:
    return f"coalesce(length(text) > 0 AND {value}, false)"


_CASE_MAP = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TOKEN_MAP.items())

DERIVE_SQL = f"""
WITH d AS (SELECT *, string_split(text, ' ') AS parts FROM documents),
e AS (SELECT *, CASE WHEN list_position(list_reverse(list_transform(parts, lambda x: x <> '')), true) IS NULL
                     THEN 0 ELSE len(parts) - list_position(list_reverse(list_transform(parts, lambda x: x <> '')), true) + 1
                END AS eff FROM d)
SELECT doc_id,
  {_d_nonempty("left(text, 10)")} AS left10,
  {_d_nonempty("right(text, 10)")} AS right10,
  {_d_nonempty("substring(text, 6, 15)")} AS substr_5_20,
  {_d_nonempty("CASE WHEN 2 < eff THEN parts[3] END")} AS split_2,
  reverse(text) AS reversed,
  coalesce(length(text), 0)::INTEGER AS len,
  lower(text) AS lower_text,
  upper(replace(text, 'ß', 'ss')) AS upper_text,
  regexp_replace(text, '^{TX.JAVA_BLANK}+|{TX.JAVA_BLANK}+\\z', '', 'g') AS trimmed,
  replace(text, 'the', 'THE') AS replaced,
  {_d_nonempty("array_to_string(list_transform(regexp_extract_all(text, '([a-z_0-9]+|[^a-z_0-9]+)', 1), lambda p: CASE p " + _CASE_MAP + " ELSE p END), '')")} AS templated,
  replace(replace(text, '"', '\\"'), '''', '\\''') AS escaped,
  {_d_flag("starts_with(text, 'The')")} AS starts_the,
  {_d_flag("ends_with(text, '.')")} AS ends_dot,
  {_d_flag("contains(text, 'the')")} AS contains_the,
  lang || '-' || source AS lang_source,
  lang || '|' || source AS joined,
  (length(text) + length(regexp_replace(text, '[^\\x{{0391}}-\\x{{FFE5}}]', '', 'g'))
   + 3 * length(regexp_replace(text, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))::INTEGER AS width,
  printf('%.3f', n_chars / 7.0) AS chars_per_7,
  regexp_replace(printf('%.3f', n_chars / 7.0), '\\.?0+\\z', '') AS chars_per_7_short
FROM e"""


@register("derive_text_columns", DERIVE_SQL)
def derive_text_columns(spark, sf_dir):
    """Q2: projections over whole document texts."""
    d = read_table(spark, sf_dir, "documents")
    t = F.col("text")
    return d.select(
        "doc_id",
        TX.left(t, 10).alias("left10"),
        TX.right(t, 10).alias("right10"),
        TX.substr(t, 5, 20).alias("substr_5_20"),
        TX.split_part(t, " ", 2).alias("split_2"),
        F.reverse(t).alias("reversed"),
        TX.text_len(t).alias("len"),
        F.lower(t).alias("lower_text"),
        F.upper(t).alias("upper_text"),
        TX.java_trim(t).alias("trimmed"),
        F.replace(t, F.lit("the"), F.lit("THE")).alias("replaced"),
        TX.replace_tokens(t, TOKEN_MAP).alias("templated"),
        TX.escape_quotes(t).alias("escaped"),
        TX.starts_with(t, "The").alias("starts_the"),
        TX.ends_with(t, ".").alias("ends_dot"),
        TX.contains(t, "the").alias("contains_the"),
        F.concat("lang", F.lit("-"), "source").alias("lang_source"),
        TX.join_skip_leading_empty(F.array(F.lit(""), "lang", "source"), "|").alias("joined"),
        TX.display_width(t).alias("width"),
        TX.display_decimal(F.col("n_chars") / 7.0).alias("chars_per_7"),
        TX.display_format(F.col("n_chars") / 7.0).alias("chars_per_7_short"),
    )


# --- Q3 smart_compare -----------------------------------------------------------------

_NUM = TX.full(TX.DOUBLE)


def _duck_cmp(a: str, b: str, op: str) -> str:
    return (f"CASE WHEN regexp_matches({a}, '{_NUM}') AND regexp_matches({b}, '{_NUM}') "
            f"THEN {a}::DOUBLE {op} {b}::DOUBLE ELSE {a} {op} {b} END")


_OPS = (("eq", "="), ("gt", ">"), ("lt", "<"), ("ge", ">="), ("le", "<="))
_PAIRS = (
    ("acct", "printf('%.2f', c_acctbal)", "format_string('%.2f', c_acctbal)",
     "(c_nationkey * 100)::VARCHAR", "cast(c_nationkey * 100 as string)"),
    ("seg", "c_mktsegment", "c_mktsegment", "'HOUSEHOLD'", "'HOUSEHOLD'"),
    ("name", "c_name", "c_name", "'5000'", "'5000'"),
)

SMART_SQL = "SELECT c_custkey, " + ", ".join(
    f"{_duck_cmp(da, db, sym)} AS {tag}_{op}"
    for tag, da, _, db, _ in _PAIRS for op, sym in _OPS) + " FROM customer"


@register("smart_compare", SMART_SQL)
def smart_compare(spark, sf_dir):
    """Q3: numeric-or-text comparisons between column pairs of customer."""
    c = read_table(spark, sf_dir, "customer")
    return c.select("c_custkey", *[
        TX.smart_compare(F.expr(sa), F.expr(sb), op).alias(f"{tag}_{op}")
        for tag, _, sa, _, sb in _PAIRS for op, _ in _OPS])


# --- Q4 derive_keys ----------------------------------------------------------------

_B36 = "'0123456789abcdefghijklmnopqrstuvwxyz'"
_DUCK_B36 = (
    "CASE WHEN doc_id = 0 THEN '0' ELSE ltrim(array_to_string(list_transform(range(12, -1, -1), "
    f"lambda i: substr({_B36}, ((doc_id // (36::HUGEINT ** i)::HUGEINT) % 36)::INTEGER + 1, 1)), ''), '0') END")
_DUCK_HASH = ("list_reduce(list_transform(string_split(text, ''), lambda ch: unicode(ch)::BIGINT), "
              "lambda acc, x: (acc * 31 + x) % 4294967296, 0::BIGINT)")

KEYS_SQL = f"""
WITH h AS (SELECT doc_id, text, CASE WHEN length(text) = 0 THEN 0 ELSE {_DUCK_HASH} END AS u FROM documents),
s AS (SELECT *, CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS hc FROM h)
SELECT doc_id, md5(text) AS text_md5, substr(md5(text), 9, 16) AS text_md5_16,
       {_DUCK_B36} AS id_base36, hc::BIGINT AS text_hashcode,
       (CASE WHEN length(text) = 0 THEN -1 WHEN hc = -2147483648 THEN hc ELSE abs(hc) END)::BIGINT
         AS text_hashcode_abs,
       (((hc % 16) + 16) % 16)::BIGINT AS text_bucket16
FROM s"""


@register("derive_keys", KEYS_SQL)
def derive_keys(spark, sf_dir):
    """Q4: md5, 16-digit md5, base-36 id, polynomial string hash and bucket."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        K.md5_hex("text").alias("text_md5"),
        K.md5_16("text").alias("text_md5_16"),
        K.base36("doc_id").alias("id_base36"),
        K.java_hashcode("text").alias("text_hashcode"),
        K.hashcode_abs("text").alias("text_hashcode_abs"),
        K.hash_bucket("text", 16).cast("bigint").alias("text_bucket16"),
    )


# --- Q5 normalize_json ---------------------------------------------------------------

@register("normalize_json", """
SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, 'k' AS keys,
       '{"k":"' || json_extract_string(props, '$.k') || '"}' AS sorted_json,
       2::INTEGER AS list_size, (2 * json_extract(props, '$.k')::BIGINT) AS list_sum
FROM events""")
def normalize_json(spark, sf_dir):
    """Q5: event props as struct, as map (sorted-key JSON), and a JSON list."""
    ev = read_table(spark, sf_dir, "events")
    m = JX.to_map("props")
    lst = JX.to_list(F.concat(F.lit("["), F.col("props"), F.lit(","), F.col("props"), F.lit("]")),
                     "struct<k: bigint>")
    return ev.select(
        "event_id",
        JX.to_struct("props", "k BIGINT").getField("k").alias("k"),
        F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"),
        JX.sorted_json(m).alias("sorted_json"),
        F.size(lst).alias("list_size"),
        F.aggregate(lst, F.lit(0).cast("bigint"), lambda acc, x: acc + x.getField("k")).alias("list_sum"),
    )


@register("normalize_json_turns", """
SELECT conv_id, turn, role AS role_back, text AS text_back, 'conv_id,role,text,turn' AS keys
FROM conversations""")
def normalize_json_turns(spark, sf_dir):
    """Q5: conversation turns to JSON and back through a map; whole texts."""
    cv = read_table(spark, sf_dir, "conversations")
    j = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    m = JX.to_map(j)
    back = JX.to_struct(JX.sorted_json(m), "role STRING, text STRING")
    return cv.select(
        "conv_id", "turn",
        back.getField("role").alias("role_back"),
        back.getField("text").alias("text_back"),
        F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"),
    )

"""Scalar cleaning functions as Spark Column expressions (C*, D*, N1, X*, F5-F9, Q*).

Every function takes and returns ``Column`` objects and uses only built-in
expressions, so they run inside whole-stage codegen. Array variants (``*_arr``)
apply the same rule element-wise with ``transform`` for header arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


# whitespace run written the same way for Java regex and RE2 (no \s / \v differences)
WS_RUN = r"[ \t\n\r\f\x0B]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- C1-C3 names
def sanitize_header(col) -> Column:
    """>= <= > < % : whitespace, then squeeze '_' runs and drop one trailing '_'."""
    c = _c(col)
    for old, new in fixed.HEADER_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, WS_RUN, "_")
    c = F.regexp_replace(c, r"__+", "_")
    return F.regexp_replace(c, r"_$", "")


def clean_column_name(col) -> Column:
    """Non [A-Za-z0-9_] -> '_', '__' -> '_' once (not repeated), one trailing '_' removed."""
    c = F.regexp_replace(_c(col), r"[^a-zA-Z0-9_]", "_")
    c = F.regexp_replace(c, r"__", "_")
    return F.regexp_replace(c, r"_$", "")


def pacbio_header(col) -> Column:
    """Each space and round bracket becomes '_'."""
    return F.translate(_c(col), " ()", "___")


def sanitize_header_py(name: str) -> str:
    """Driver-side twin of C1 used only on column-name lists (metadata, never data)."""
    import re
    for old, new in fixed.HEADER_REPLACEMENTS:
        name = name.replace(old, new)
    name = re.sub(r"[ \t\n\r\f\v]+", "_", name)
    name = re.sub(r"__+", "_", name)
    return re.sub(r"_$", "", name)


def clean_column_name_py(name: str) -> str:
    """Driver-side twin of C2 for schema evolution (column names only)."""
    import re
    name = re.sub(r"[^a-zA-Z0-9_]", "_", name)
    name = name.replace("__", "_")
    return re.sub(r"_$", "", name)


# ---------------------------------------------------------------- C4-C16 text
def strip_inner_commas(col) -> Column:
    """C4 on an already CSV-parsed cell: thousands separators and quotes go."""
    return F.regexp_replace(F.regexp_replace(_c(col), ",", ""), '"', "")


def strip_inner_commas_line(col) -> Column:
    """C4 on a raw line: commas inside double-quoted parts removed, then all quotes removed."""
    parts = F.split(_c(col), '"', -1)
    cleaned = F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.replace(x, F.lit(","), F.lit(""))).otherwise(x))
    return F.array_join(cleaned, "")


def trim_slashes(col) -> Column:
    return F.regexp_replace(_c(col), r"^/+|/+$", "")


def delivery_folder(col, application=None) -> Column:
    """Strip slashes; with a '/' take the 2nd-to-last part (PacBio: 3rd-to-last); else as is.

    Too few parts or an empty result is missing (ledger L-8).
    """
    p = trim_slashes(col)
    parts = F.split(p, "/", -1)
    if application is None:
        depth = F.lit(2)
    else:
        depth = F.when(_app(application) == "PacBio", F.lit(3)).otherwise(F.lit(2))
    picked = F.when(F.size(parts) >= depth, F.try_element_at(parts, -depth))
    out = F.when(F.instr(p, "/") > 0, picked).otherwise(p)
    return F.nullif(F.trim(out), F.lit(""))


def _app(application) -> Column:
    return application if isinstance(application, Column) else F.lit(application)


def parent_dir(col) -> Column:
    """C6 `${x%/*}`."""
    return F.regexp_extract(_c(col), r"^(.*)/[^/]*$", 1)


def base_name(col) -> Column:
    """C6 `${x##*/}`."""
    return F.element_at(F.split(_c(col), "/", -1), -1)


def last_token(col, sep="_") -> Column:
    """C7 text after the last separator."""
    return F.substring_index(_c(col), sep, -1)


def first_token(col, sep=".") -> Column:
    """C7 text before the first separator."""
    return F.substring_index(_c(col), sep, 1)


def normalize_species(col) -> Column:
    """Every hit rewritten, substring, case-sensitive."""
    c = _c(col)
    for pattern, repl in fixed.SPECIES_REWRITES:
        c = F.regexp_replace(c, pattern, repl)
    return c


def collapse_spaces(col) -> Column:
    """C11 like `xargs`: trim and squeeze inner whitespace."""
    return F.trim(F.regexp_replace(_c(col), WS_RUN, " "))


def strip_quotes(col) -> Column:
    return F.regexp_replace(_c(col), '"', "")


def extract_after(col, label: str) -> Column:
    """C12 trimmed text after a label (first occurrence), NULL when absent."""
    c = _c(col)
    pos = F.instr(c, label)
    return F.when(pos > 0, F.trim(F.substr(c, pos + F.lit(len(label)))))


def is_numeric(col, kind: str = "decimal") -> Column:
    """C13: 'decimal' (unsigned), 'sci' (sign + exponent), 'digits'."""
    return F.coalesce(_c(col).rlike(fixed.NUMERIC_PATTERNS[kind]), F.lit(False))


def percent_value(col) -> Column:
    """C14: remove one trailing '%'."""
    return F.regexp_replace(_c(col), "%$", "")


def split_list(col, sep=",") -> Column:
    """C16 + S15: split, trim (spaces), drop blanks, keep first occurrence. Written without
    lambdas (the split pattern eats the spaces around each separator) so it stays in
    generated code."""
    import re
    parts = F.split(F.trim(_c(col)), f" *{re.escape(sep)} *", -1)
    return F.array_distinct(F.array_remove(parts, ""))


# ---------------------------------------------------------------- D*, N1, X*
def release_date(col) -> Column:
    """Free-form text -> DATE by trying fixed formats; unparsable/empty -> NULL (L-9)."""
    c = F.trim(_c(col))
    c = F.when(c != "", c)
    return F.coalesce(*[F.try_to_date(c, fmt) for fmt in fixed.RELEASE_DATE_FORMATS])


def release_date_text(col) -> Column:
    return F.date_format(release_date(col), "yyyy-MM-dd")


def days_between(later, earlier) -> Column:
    """D2 whole days."""
    return F.datediff(_c(later), _c(earlier))


def older_than(ts_col, days: int, today=None) -> Column:
    """D3 file/row age test."""
    now = F.current_date() if today is None else F.to_date(F.lit(today))
    return F.datediff(now, F.to_date(_c(ts_col))) > days


def day_stamp(col) -> Column:
    """D4 `YYYYMMDD`."""
    return F.date_format(_c(col), "yyyyMMdd")


def fraction_to_percent(col) -> Column:
    """x*100 printed with 2 decimals; text that is not a number stays NULL."""
    v = _c(col).try_cast("double")
    return F.when(v.isNotNull(), F.format_string("%.2f", v * 100))


def coalesce_missing(col) -> Column:
    """X1 '' -> NULL."""
    return F.nullif(_c(col), F.lit(""))


def is_missing(col) -> Column:
    """NULL, '', 'null', 'nan', 'n.a.' (any case, trimmed)."""
    c = _c(col)
    return c.isNull() | F.lower(F.trim(c)).isin(*fixed.MISSING_TOKENS)


def proj_status(folder, date) -> Column:
    """X2 (one rule for every platform, ledger L-4)."""
    return F.when(is_missing(folder) | is_missing(date), F.lit("Undelivered")).otherwise(F.lit("Delivered"))


def value_is_dropped(col) -> Column:
    """F7 predicate: long short-read value to drop (trimmed, lower-case)."""
    c = _c(col)
    return c.isNull() | F.lower(F.trim(c)).isin(*fixed.DROP_VALUE_TOKENS) | (F.trim(c) == "")


def nullify_missing(col) -> Column:
    """F8: 'nan', 'n.a', 'n.a.' in any case become NULL; the row stays."""
    c = _c(col)
    return F.when(~F.lower(c).isin(*fixed.NULLIFY_VALUE_TOKENS), c)


def pad_array(arr, width) -> Column:
    """pad an array of cells with NULLs to the header width."""
    a = _c(arr)
    w = width if isinstance(width, Column) else F.lit(width)
    missing = F.greatest(w - F.size(a), F.lit(0))
    return F.concat(a, F.array_repeat(F.lit(None).cast("string"), missing))


# ---------------------------------------------------------------- Q* JSON
def json_value(json_col, key: str) -> Column:
    """Q1: `$.key`, else a line scan `"key": "v"` for text that does not parse; trimmed; '' -> NULL."""
    j = _c(json_col)
    parsed = F.get_json_object(j, f"$.{key}")
    scanned = F.regexp_extract(j, rf'"{key}"\s*:\s*"([^"]*)"', 1)
    v = F.coalesce(F.nullif(parsed, F.lit("null")), F.nullif(scanned, F.lit("")))
    return F.nullif(collapse_spaces(v), F.lit(""))


def parse_json(json_col) -> Column:
    """A document parsed once for many lookups (Q1-Q5): a VARIANT, NULL for text that does not parse."""
    return F.try_parse_json(_c(json_col))


def variant_value(parsed, json_col, key: str) -> Column:
    """Q1 on a parsed document: `$.key`, else (no document) the line scan of its text; trimmed; '' and null -> NULL."""
    scanned = F.nullif(F.regexp_extract(_c(json_col), rf'"{key}"\s*:\s*"([^"]*)"', 1), F.lit(""))
    found = F.coalesce(F.nullif(F.try_variant_get(_c(parsed), f"$.{key}", "string"), F.lit("null")), scanned)
    return F.nullif(collapse_spaces(found), F.lit(""))


def variant_first_element(parsed, key: str) -> Column:
    """Q4 on a parsed document."""
    return F.nullif(F.try_variant_get(_c(parsed), f"$.{key}[0]", "string"), F.lit(""))


def json_regex(json_col, key: str) -> Column:
    """Q2 regex-only lookup of a string value."""
    return F.nullif(F.regexp_extract(_c(json_col), rf'"{key}"\s*:\s*"([^"]*)"', 1), F.lit(""))


def json_first_path(json_col) -> Column:
    """Q3 first string under any key `path`, in document order."""
    return F.nullif(F.regexp_extract(_c(json_col), r'"path"\s*:\s*"([^"]*)"', 1), F.lit(""))


def json_first_element(json_col, key: str) -> Column:
    """Q4 first element of an array value."""
    return F.nullif(F.get_json_object(_c(json_col), f"$.{key}[0]"), F.lit(""))


def first_hit(text_col, rules, default=None) -> Column:
    """C9-style ordered substring rules: first rule whose pattern is contained wins."""
    c = _c(text_col)
    expr = None
    for pattern, out in rules:
        cond = F.instr(c, pattern) > 0
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    fallback = c if default is None else default
    return expr.otherwise(fallback)


def instrument_id(name_col, platform: str) -> Column:
    """First matching substring rule; else the name itself; else NULL."""
    rules = fixed.PACBIO_INSTRUMENTS if platform == "PacBio" else fixed.ONT_INSTRUMENTS
    return first_hit(F.nullif(_c(name_col), F.lit("")), rules)

"""What ``stemma.functions.text`` says, as SQL for an engine whose patterns cannot look around."""

from __future__ import annotations

from stemma.functions import text as T

#: White space of any script, as a class.
WHITE = r"\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def first(column: str, pattern: str) -> str:
    return f"nullif(regexp_extract({column}, '{pattern}', 1), '')"


def volume(column: str) -> str:
    return f"cast(round_even(coalesce(try_cast({first(column, T.ML_PATTERN)} as double), try_cast({first(column, T.LITRE_PATTERN)} as double) * 1000), 0) as integer)"


def pack(column: str) -> str:
    figures = [f"try_cast({first(column, p)} as integer)" for p in T.PACK_PATTERNS]
    return "coalesce(" + ", ".join(f"(case when {n} between 1 and 48 then {n} end)" for n in figures) + ")"


def abv(column: str) -> str:
    v = f"try_cast({first(column, T.ABV_PATTERN)} as double)"
    return f"case when {v} > 0 and {v} <= 80 then {v} end"


def year(column: str, last: int) -> str:
    return f"list_max(list_filter(list_transform(regexp_extract_all({column}, '{T.YEAR_PATTERN}', 1), lambda y: cast(y as integer)), lambda y: y <= {last}))"


def price(column: str) -> str:
    figure = first(f"replace({column}, '$', '')", T.PRICE_PATTERN)
    return f"floor(try_cast(replace({figure}, ',', '') as double) * 100 + 0.5) / 100"


def category(blob: str) -> str:
    """blob: lower-cased."""
    rules = " ".join(f"when regexp_matches({blob}, '(^|[^a-z])({'|'.join(words)})($|[^a-z])') then '{name}'" for name, words in T.CATEGORY_WORDS.items())
    return f"case when length({blob}) = 0 then null {rules} else 'other' end"


def clean(column: str) -> str:
    # What T looks ahead to and back at is matched and put back.
    s = f"regexp_replace(coalesce({column}, ''), '{T.SIZES_PATTERN}', ' ', 'g')"
    s = f"regexp_replace({s}, '([a-z])([A-Z][a-z])', '\\1 \\2', 'g')"
    s = f"regexp_replace({s}, '{T.SCOTS_PATTERN}', '\\1\\2', 'g')"
    s = f"regexp_replace({s}, '[–—]', '-', 'g')"
    s = f"regexp_replace({s}, '(?i)(^|\\s)[x×](\\s|$)', ' \\2', 'g')"
    s = f"regexp_replace({s}, '{T.LAST_SIGN_PATTERN}', '')"
    return f"trim(regexp_replace({s}, '\\s{{2,}}', ' ', 'g'))"


def decode(s: str) -> str:
    for a, b in T.ENTITIES.items():
        s = "replace({}, '{}', '{}')".format(s, a.replace("'", "''"), b.replace("'", "''"))
    return s


def stripped(s: str) -> str:
    return f"regexp_replace({s}, '^[{WHITE}]+|[{WHITE}]+$', '', 'g')"


def strip_html(s: str) -> str:
    plain = decode(f"regexp_replace({s}, '<[^>]+>', ' ', 'g')")
    return f"nullif(trim(regexp_replace({plain}, '[{WHITE}]+', ' ', 'g')), '')"


def keyed(source: str, name: str, brand: str = "brand", of: str = "name") -> str:
    """Common table expressions: name, of the rows of source with volume_ml and vintage, adds slug, bare_slug and product_key."""
    return f"""{name}_words as (select *, list_filter(string_split_regex(regexp_replace(lower(concat_ws(' ', {clean(brand)}, {clean(of)})), '[^a-z0-9\\s]', ' ', 'g'), '\\s+'), lambda t: t <> '') as w from {source}),
{name}_base as (select *, array_to_string(list_filter(w, lambda t, i: list_position(w, t) = i), ' ') as base from {name}_words),
{name}_slug as (select *, concat(base, case when coalesce(volume_ml, 0) <> 0 then concat(' ', volume_ml, 'ml') else '' end, case when coalesce(vintage, 0) <> 0 then concat(' ', vintage) else '' end) as slug,
  concat(base, case when coalesce(vintage, 0) <> 0 then concat(' ', vintage) else '' end) as bare_slug from {name}_base),
{name} as (select *, substr(sha1(slug), 1, 16) as product_key from {name}_slug)"""

"""Pieces of SQL text used by the checks."""

from __future__ import annotations

import re


def title(x: str) -> str:
    """Capital after every character that is neither letter nor digit, lower case elsewhere."""
    runs = rf"regexp_extract_all(lower({x}), '([\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1]) || t[2:]), '')"


def repaired(x: str) -> str:
    return (
        f"replace(replace(replace(replace(replace({x}, '''T', '''t'), '''S', '''s'), "
        "'''D', '''d'), '''M', '''m'), '''Ll', '''ll')"
    )


def title_known(x: str) -> str:
    return f"coalesce(nullif(nullif({title(f'trim({x})')}, 'Nan'), ''), 'Unknown')"


def as_is_known(x: str, default: str = "Unknown") -> str:
    missing = f"{x} IS NULL OR lower(trim({x})) IN ('nan', '')"
    return f"CASE WHEN {missing} THEN '{default}' ELSE trim({x}) END"


def lower_known(x: str) -> str:
    return f"lower({as_is_known(x, 'unknown')})"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def digits_int(x: str) -> str:
    return f"TRY_CAST({digits(x)} AS INTEGER)"


def stamp(x: str) -> str:
    return f"coalesce(strftime({x}, '%Y-%m-%d %H:%M:%S'), '')"


def ts(x: str) -> str:
    """Timestamp as text for comparison."""
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def filled(x: str) -> str:
    return f"coalesce(lower(trim({x})), '')"


def ratio(x: str, y: str, places: int = 2) -> str:
    """Whole numbers x / y rounded half away from zero; NULL when y = 0."""
    scale = 10**places
    x = f"CAST({x} AS HUGEINT)"
    y = f"nullif(CAST({y} AS HUGEINT), 0)"
    return (
        f"(CAST(sign({x}) * ((2 * abs({x}) * {scale} + {y}) // (2 * {y})) AS DOUBLE)"
        f" / {scale}.0)"
    )


def percent(part: str, whole: str) -> str:
    return ratio(f"100 * ({part})", whole)


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def mean_money(total: str, count: str, places: int = 2) -> str:
    """Mean of a money sum: cents over count, so two places fewer are left to scale."""
    return f"({ratio(cents(total), count, places - 2)} / 100.0)" if places == 2 else (
        ratio(cents(total), f"100 * ({count})", places)
    )


def mean_int(total: str, count: str) -> str:
    return ratio(total, count)


def money(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def with_tables(tables: dict[str, str], query: str) -> str:
    """The query behind a WITH list of the tables it uses, directly or through others."""
    word = re.compile(r"[a-z_][a-z_0-9]*")
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(word.findall(text)):
            if name in tables and name not in ordered:
                need(tables[name])
                if name not in ordered:
                    ordered.append(name)

    need(query)
    if not ordered:
        return query
    body = ",\n".join(f"{name} AS (\n{tables[name]}\n)" for name in ordered)
    return f"WITH {body}\n{query}"

"""Expressions for raw codes, values and keys, as SQL text.

Each function takes a column name or expression and gives one back, for
``selectExpr`` or ``F.expr``; an expression of many columns is then one call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cubestar.schema import (
    NULL_SENTINELS,
    NUMBER_PREFIX,
    RAW_COLUMNS,
    SLOT_CODES,
)

# The characters counted as white space at the edges of a code.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SENTINELS = ", ".join(f"'{s}'" for s in NULL_SENTINELS)


def null_sentinel(c: str) -> str:
    """The exact texts ``...`` and ``-`` become NULL."""
    return f"CASE WHEN {c} NOT IN ({_SENTINELS}) THEN {c} END"


def null_sentinels(df: DataFrame, columns=RAW_COLUMNS) -> DataFrame:
    """S2 in every given column the frame has; other columns pass through."""
    return df.selectExpr(
        *(
            f"{null_sentinel(f'`{c}`')} AS `{c}`" if c in columns else f"`{c}`"
            for c in df.columns
        )
    )


def coerce(c: str) -> str:
    """Text of the value, NULL stays NULL."""
    return f"CAST({c} AS STRING)"


def strip(c: str) -> str:
    return f"btrim({c}, '{WHITE_SPACE}')"


def stripped_text(c: str) -> str:
    return strip(f"coalesce({coerce(c)}, '')")


def without_decimal(c: str) -> str:
    """Drop one trailing ``.0``."""
    return f"CASE WHEN endswith({c}, '.0') THEN left({c}, length({c}) - 2) ELSE {c} END"


def clean_code(c: str) -> str:
    """NULL to empty, strip, drop one trailing ``.0``."""
    return without_decimal(stripped_text(c))


def normalize_level(c: str) -> str:
    """``6`` becomes ``N6``; ``N6`` and the empty text are kept."""
    return f"CASE WHEN {c} <> '' AND NOT startswith({c}, 'N') THEN concat('N', {c}) ELSE {c} END"


def with_place_key(df: DataFrame, level: str = "NC", place: str = "D1C") -> DataFrame:
    """(level, place code) of raw rows as ``nc`` and ``d1c``.

    One step per select, so that no step repeats the work of the one before.
    """
    others = [f"`{c}`" for c in df.columns if c.lower() not in ("nc", "d1c")]
    stripped = df.selectExpr(
        *others, f"{stripped_text(level)} AS nc", f"{stripped_text(place)} AS d1c"
    )
    codes = stripped.selectExpr(
        *others, f"{without_decimal('nc')} AS nc", f"{without_decimal('d1c')} AS d1c"
    )
    return codes.selectExpr(*others, f"{normalize_level('nc')} AS nc", "d1c")


def dimension_key() -> list[str]:
    """P5: the eight member codes of a raw row, NULL kept."""
    return [f"{coerce(c)} AS {c.lower()}" for c in ("MC", "D2C", *SLOT_CODES)]


def dimension_names() -> list[str]:
    """Unit and variable names default to empty, category names stay NULL."""
    filled = [f"coalesce({coerce(c)}, '') AS {c.lower()}" for c in ("MN", "D2N")]
    names = [c[:2] + "N" for c in SLOT_CODES]
    return filled + [f"{coerce(n)} AS {n.lower()}" for n in names]


def numeric_value(v: str, strict: bool = False) -> str:
    """The number a value text starts like, else NULL.

    The guard looks only at the first characters; a text such as ``12abc``
    passes it and then fails the cast when ``strict``, or gives NULL.
    """
    cast = "CAST" if strict else "try_cast"
    return f"CASE WHEN {v} RLIKE '{NUMBER_PREFIX}' THEN {cast}({v} AS DECIMAL(38,10)) END"


def value_flag(v: str) -> str:
    """P10: number, one of the documented flags, or other."""
    return (
        f"CASE WHEN {v} RLIKE '{NUMBER_PREFIX}' THEN 'number'"
        f" WHEN {v} IN ('X', 'C', '..', '...', '-') THEN {v} ELSE 'other' END"
    )


def content_key(*columns: str) -> str:
    """md5 over length-prefixed parts, so NULL, empty and shifts differ."""
    parts = ", ".join(
        f"coalesce(concat('v', CAST(length({c}) AS STRING), ':', {c}), 'n')"
        for c in columns
    )
    return f"md5(concat({parts}))"


def literals_text(c: str) -> str:
    """One text per list of texts; NULL stays NULL and differs from empty."""
    item = "coalesce(concat('|', CAST(length(x) AS STRING), ':', x), '|n')"
    return f"concat(CAST(size({c}) AS STRING), array_join(transform({c}, x -> {item}), ''))"


def period_key(codigo: str, literals: str) -> str:
    return content_key(codigo, literals_text(literals))

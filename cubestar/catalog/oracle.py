"""Pieces of DuckDB SQL the comparison statements are put together from."""

from __future__ import annotations

from cubestar.catalog.inputs import with_inputs
from cubestar.schema import DIMENSION_COLUMNS, DIMENSION_KEY, SLOTS

RAW = (
    "NC", "NN", "D1C", "D1N", "MC", "MN", "D2C", "D2N", "D3C",
    "D4C", "D4N", "D5C", "D5N", "V",
)
UPPER_SLOTS = tuple(f"d{s}{k}" for s in SLOTS[2:] for k in "cn")


def nulled(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ('...', '-') THEN {c} END"


def stripped(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def cleaned(c: str) -> str:
    return f"regexp_replace({stripped(f'coalesce({c}, {chr(39) * 2})')}, '\\.0$', '')"


def level(c: str) -> str:
    return f"CASE WHEN {c} <> '' AND {c} NOT LIKE 'N%' THEN concat('N', {c}) ELSE {c} END"


def key(*columns: str) -> str:
    parts = ", ".join(
        f"CASE WHEN {c} IS NULL THEN 'n'"
        f" ELSE concat('v', CAST(length({c}) AS VARCHAR), ':', {c}) END"
        for c in columns
    )
    return f"md5(concat({parts}))"


DIM_ID = key(*DIMENSION_KEY)
PLACE_ID = key("nc", "d1c")
DIMS = ", ".join(DIMENSION_COLUMNS)


def cells(batch: str) -> str:
    """CTEs ``{batch}_raw`` (sentinels NULL) and ``{batch}_cells`` (clean, valued)."""
    raw = ", ".join(f"{nulled(c)} AS {c}" for c in RAW)
    upper = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in UPPER_SLOTS)
    extra = ", modificacao, file_path" if batch.endswith("_batch") else ""
    return f"""
{batch}_raw AS MATERIALIZED (SELECT tabela_sidra_id{extra}, {raw} FROM {batch}),
{batch}_cells AS MATERIALIZED (
  SELECT tabela_sidra_id{extra},
         {level(cleaned('NC'))} AS nc, NN AS raw_nn, {stripped("coalesce(NN, '')")} AS nn,
         {cleaned('D1C')} AS d1c, D1N AS raw_d1n, {stripped("coalesce(D1N, '')")} AS d1n,
         MC AS mc, coalesce(MN, '') AS mn, D2C AS d2c, coalesce(D2N, '') AS d2n,
         D4C AS d4c, D4N AS d4n, D5C AS d5c, D5N AS d5n, {upper},
         D3C AS codigo, V AS v
  FROM {batch}_raw WHERE V IS NOT NULL)"""


# Distinct periods of the descriptions, with ids.
PERIODS = f"""
period_rows AS MATERIALIZED (
  SELECT DISTINCT codigo, frequencia, ano, semestre, mes,
         CASE WHEN frequencia = 'semestral'
              THEN concat('2|', length(codigo), ':', codigo, '|8:semestre')
              ELSE concat('1|', length(codigo), ':', codigo) END AS literals_text
  FROM meta_periods),
periods AS MATERIALIZED (
  SELECT {key('codigo', 'literals_text')} AS id, * FROM period_rows)"""


def resolved(batch: str) -> str:
    """CTE ``{batch}_resolved``: ids of every valued cell, or why it has none."""
    return f"""
{batch}_resolved AS MATERIALIZED (
  SELECT c.tabela_sidra_id, c.modificacao, c.file_path, c.codigo, c.v,
         {PLACE_ID} AS localidade_id,
         CASE WHEN d2c IS NOT NULL THEN {DIM_ID} END AS dimensao_id,
         p.id AS periodo_id,
         CASE WHEN d2c IS NULL THEN 'dimensao'
              WHEN p.id IS NULL THEN 'periodo' END AS reject_reason
  FROM {batch}_cells c
  JOIN meta_cubes m ON m.id = c.tabela_sidra_id
  LEFT JOIN periods p ON p.codigo = c.codigo AND p.frequencia = m.frequencia)"""


CELL = "tabela_sidra_id, localidade_id, dimensao_id, periodo_id"


def facts() -> str:
    """CTE ``facts``: the star's facts after the first publication."""
    return f"""
facts AS MATERIALIZED (
  SELECT {CELL}, modificacao, TRUE AS ativo, v FROM old_batch_resolved
  WHERE reject_reason IS NULL)"""


def batch_inputs(*batches: str) -> str:
    """Everything up to the resolved cells of the batches, and stored facts."""
    parts = [with_inputs(*batches, "meta_cubes", "meta_periods"), PERIODS]
    for b in batches:
        parts += [cells(b), resolved(b)]
    if "old_batch" in batches:
        parts.append(facts())
    return "WITH " + ",".join(parts)


def star_rows() -> str:
    """CTE ``flat``: active cells of the first publication with their members."""
    order = "modificacao DESC, file_path"
    return f"""
WITH {with_inputs('old_batch', 'meta_cubes', 'meta_periods', 'meta_places')},
{PERIODS},{cells('old_batch')},
{place_rows()},
dims AS MATERIALIZED (
  SELECT {DIMS} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {', '.join(DIMENSION_KEY)}
      ORDER BY {order}, mn, d2n, d4n, d5n) AS rn
    FROM old_batch_cells WHERE d2c IS NOT NULL) AS x WHERE rn = 1),
flat AS MATERIALIZED (
  SELECT c.tabela_sidra_id, p.codigo, p.ano, p.mes, l.nc, l.nn, l.d1c, l.d1n,
         d.mn, d.d2n, d.d4n, d.d5n, c.v,
         CASE WHEN regexp_matches(c.v, '^-?[0-9]')
              THEN TRY_CAST(c.v AS DECIMAL(38,10)) END AS num
  FROM old_batch_cells c
  JOIN meta_cubes m ON m.id = c.tabela_sidra_id
  JOIN periods p ON p.codigo = c.codigo AND p.frequencia = m.frequencia
  JOIN dims d ON d.d2c = c.d2c AND d.mc IS NOT DISTINCT FROM c.mc
             AND d.d4c IS NOT DISTINCT FROM c.d4c
             AND d.d5c IS NOT DISTINCT FROM c.d5c
  JOIN places l ON l.nc = c.nc AND l.d1c = c.d1c)"""


def place_rows() -> str:
    """CTE ``places``: descriptions first, then the first publication."""
    meta_level = level("nivel")
    return f"""
meta_place_rows AS MATERIALIZED (
  SELECT nc, d1c, nn, d1n FROM (
    SELECT {meta_level} AS nc, id AS d1c, nivel_nome AS nn, nome AS d1n,
           row_number() OVER (PARTITION BY {meta_level}, id
                              ORDER BY tabela_sidra_id, nivel_nome, nome) AS rn
    FROM meta_places) AS x WHERE rn = 1),
data_place_rows AS MATERIALIZED (
  SELECT nc, d1c, nn, d1n FROM (
    SELECT nc, d1c, nn, d1n,
           row_number() OVER (PARTITION BY nc, d1c
                              ORDER BY modificacao DESC, file_path, raw_nn, raw_d1n) AS rn
    FROM old_batch_cells) AS x WHERE rn = 1),
places AS MATERIALIZED (
  SELECT * FROM meta_place_rows
  UNION ALL
  SELECT d.* FROM data_place_rows d
  LEFT JOIN meta_place_rows m ON m.nc = d.nc AND m.d1c = d.d1c WHERE m.nc IS NULL)"""


def select(ctes: str, body: str) -> str:
    return f"{ctes}\n{body}"


def from_inputs(names: tuple[str, ...], body: str, *more: str) -> str:
    return "WITH " + ",".join([with_inputs(*names), *more]) + "\n" + body

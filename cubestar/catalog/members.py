"""Queries on expansion and dimensions (X, D, J6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubestar.catalog import inputs
from cubestar.catalog.oracle import (
    DIM_ID,
    DIMS,
    PERIODS,
    PLACE_ID,
    batch_inputs,
    cells,
    from_inputs,
    place_rows,
)
from cubestar.catalog.registry import map_text, query
from cubestar.catalog.scans import _MEMBERS, _requests
from cubestar.functions.codes import null_sentinels
from cubestar.operators.dimensions import (
    distinct_dimensions,
    distinct_period_codes,
    distinct_places,
    insert_absent,
    periods_from_metadata,
    places_from_metadata,
    unique_tables,
    upsert_catalogue,
    upsert_periods,
)
from cubestar.operators.expand import (
    dimension_members,
    expand_requests,
    member_counts,
    plan_periods,
    unnest_requests,
)
from cubestar.operators.facts import batch_cells, new_cells
from cubestar.operators.lookups import resolve_by_content
from cubestar.operators.surrogates import PERIOD_KEY, PLACE_KEY, with_content_keys
from cubestar.operators.units import enrich_units
from cubestar.plans.load import insert_members
from cubestar.schema import DIMENSION_COLUMNS, DIMENSION_KEY, empty_star
from cubestar.sources.workdir import staged

_META = ("meta_cubes", "meta_variables", "meta_categories")
_KEYS = ", ".join(DIMENSION_KEY)


def _old(spark, sf):
    return null_sentinels(inputs.source(spark, sf, "old_batch"))


# --- expansion ------------------------------------------------------------


@query(
    "x1_dimension_members",
    from_inputs(_META, f"SELECT tabela_sidra_id, {DIMS} FROM members", _MEMBERS),
)
def x1(spark, sf):
    return dimension_members(inputs.metadata(spark, sf))


@query(
    "x1_member_counts",
    from_inputs(
        _META,
        "SELECT tabela_sidra_id, count(*) AS n_members FROM members GROUP BY tabela_sidra_id",
        _MEMBERS,
    ),
)
def x1_counts(spark, sf):
    return member_counts(inputs.metadata(spark, sf))


@query(
    "x2_carried_units",
    from_inputs(
        _META,
        """SELECT v.tabela_sidra_id, v.id AS d2c, one.cat_id AS d4c, two.cat_id AS d5c,
       three.cat_id AS d6c,
       coalesce(last_value(coalesce(one.unidade, two.unidade, three.unidade) IGNORE NULLS)
                OVER (PARTITION BY v.tabela_sidra_id, v.id
                      ORDER BY one.cat_pos, one.cat_id, two.cat_pos, two.cat_id,
                               three.cat_pos, three.cat_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), v.unidade) AS mn
FROM meta_variables v
LEFT JOIN one ON one.tabela_sidra_id = v.tabela_sidra_id
LEFT JOIN two ON two.tabela_sidra_id = v.tabela_sidra_id
LEFT JOIN three ON three.tabela_sidra_id = v.tabela_sidra_id""",
        _MEMBERS,
    ),
)
def x2(spark, sf):
    # Small blocks, so that units are carried across blocks here too.
    members = dimension_members(
        inputs.metadata(spark, sf), carry_units=True, block_size=16
    )
    return members.select("tabela_sidra_id", "d2c", "d4c", "d5c", "d6c", "mn")


_COMBINATION = """
SELECT one.tabela_sidra_id AS id,
       concat(one.cls_id, '=', one.cat_id, ';', two.cls_id, '=', two.cat_id,
              CASE WHEN three.cat_id IS NULL THEN ''
                   ELSE concat(';', three.cls_id, '=', three.cat_id) END) AS classifications
FROM (SELECT * FROM one WHERE cat_id <> '0') AS one
JOIN (SELECT * FROM two WHERE cat_id <> '0') AS two
  ON two.tabela_sidra_id = one.tabela_sidra_id
LEFT JOIN three ON three.tabela_sidra_id = one.tabela_sidra_id"""


@query("x3_unnested_requests", from_inputs(_META, _COMBINATION, _MEMBERS))
def x3(spark, sf):
    cubes = inputs.metadata(spark, sf).select("id", "classificacoes")
    return unnest_requests(cubes, ["id"]).select(
        "id", map_text("combination").alias("classifications")
    )


def _expanding(spark, sf, unnest, ids=(), static=None, variables=None, split=False):
    requests = _requests(spark, sf).withColumns(
        {
            "request_id": F.col("tabela_sidra"),
            "unnest": F.lit(unnest),
            "unnest_ids": F.array(*(F.lit(i) for i in ids)).cast("array<string>"),
            "split_variables": F.lit(split),
        }
    )
    if static is not None:
        requests = requests.withColumn(
            "classifications",
            F.create_map(F.lit(static[0]), F.array(F.lit(static[1]))),
        )
    if variables is not None:
        requests = requests.withColumn(
            "variables", F.array(*(F.lit(v) for v in variables))
        )
    return requests


@query(
    "x4_partial_unnest",
    from_inputs(
        _META,
        """SELECT k.tabela_sidra_id AS tabela_sidra,
       concat('81=allxt', CASE WHEN b.tabela_sidra_id IS NULL THEN '' ELSE ';41=all' END,
              ';87=', k.cat_id) AS classifications
FROM meta_categories k
LEFT JOIN (SELECT DISTINCT tabela_sidra_id FROM meta_categories WHERE cls_id = '41') b
  ON b.tabela_sidra_id = k.tabela_sidra_id
WHERE k.cls_id = '87' AND k.cat_id <> '0'""",
    ),
)
def x4(spark, sf):
    requests = _expanding(spark, sf, "listed", ids=("87",), static=("81", "allxt"))
    return expand_requests(requests, inputs.metadata(spark, sf)).select(
        "tabela_sidra", map_text("classifications").alias("classifications")
    )


@query(
    "x5_full_unnest",
    from_inputs(
        _META,
        f"SELECT id AS tabela_sidra, classifications FROM ({_COMBINATION}) AS c",
        _MEMBERS,
    ),
)
def x5(spark, sf):
    requests = _expanding(spark, sf, "all", static=("99", "dropped"))
    return expand_requests(requests, inputs.metadata(spark, sf)).select(
        "tabela_sidra", map_text("classifications").alias("classifications")
    )


@query(
    "x6_split_variables",
    from_inputs(
        ("meta_variables",),
        "SELECT tabela_sidra_id AS tabela_sidra, id AS variables FROM meta_variables",
    ),
)
def x6(spark, sf):
    listed = inputs.metadata(spark, sf).select(
        F.col("id").alias("tabela_sidra"),
        F.transform("variaveis", lambda v: v["id"]).alias("listed"),
    )
    requests = (
        _expanding(spark, sf, None, split=True)
        .join(listed, "tabela_sidra")
        .withColumn("variables", F.col("listed"))
        .withColumn("unnest", F.col("unnest").cast("string"))
    )
    return expand_requests(requests, inputs.metadata(spark, sf)).select(
        "tabela_sidra", F.array_join("variables", ",").alias("variables")
    )


@query(
    "x6_combined_with_unnest",
    from_inputs(
        _META,
        f"""SELECT c.id AS tabela_sidra, unnest(['1', '2']) AS variables, c.classifications
FROM ({_COMBINATION}) AS c""",
        _MEMBERS,
    ),
)
def x6_combined(spark, sf):
    requests = _expanding(spark, sf, "all", variables=("1", "2"), split=True)
    expanded = expand_requests(requests, inputs.metadata(spark, sf), combine=True)
    return expanded.select(
        "tabela_sidra",
        F.array_join("variables", ",").alias("variables"),
        map_text("classifications").alias("classifications"),
    )


@query(
    "x7_period_plan",
    from_inputs(
        ("meta_periods", "meta_categories"),
        """SELECT p.tabela_sidra_id AS tabela_sidra, p.codigo AS period,
       CAST(p.modificacao AS VARCHAR) AS modificacao, 'all' AS variables,
       coalesce(c.classes, '') AS classifications
FROM meta_periods p
LEFT JOIN (
  SELECT tabela_sidra_id, string_agg(concat(cls_id, '='), ';' ORDER BY pos) AS classes
  FROM (SELECT DISTINCT tabela_sidra_id, pos, cls_id FROM meta_categories) AS k
  GROUP BY tabela_sidra_id) c ON c.tabela_sidra_id = p.tabela_sidra_id""",
    ),
)
def x7(spark, sf):
    plan = plan_periods(_requests(spark, sf), inputs.metadata(spark, sf))
    return plan.select(
        "tabela_sidra",
        F.col("periods")[0].alias("period"),
        "modificacao",
        F.array_join("variables", ",").alias("variables"),
        map_text("classifications").alias("classifications"),
    )


# --- distinct members and upserts -----------------------------------------


@query(
    "d1_distinct_places",
    "WITH " + inputs.with_inputs("old_batch") + "," + cells("old_batch")
    + f"""
SELECT {PLACE_ID} AS id, nc, nn, d1c, d1n FROM (
  SELECT *, row_number() OVER (PARTITION BY nc, d1c
    ORDER BY modificacao DESC, file_path, raw_nn, raw_d1n) AS rn FROM old_batch_cells) AS x
WHERE rn = 1""",
)
def d1(spark, sf):
    return distinct_places(_old(spark, sf)).withColumnRenamed("key", "id")


@query(
    "d2_distinct_dimensions",
    "WITH " + inputs.with_inputs("old_batch") + "," + cells("old_batch")
    + f"""
SELECT {DIM_ID} AS id, {DIMS} FROM (
  SELECT *, row_number() OVER (PARTITION BY {_KEYS}
    ORDER BY modificacao DESC, file_path, mn, d2n, d4n, d5n) AS rn
  FROM old_batch_cells WHERE d2c IS NOT NULL) AS x
WHERE rn = 1""",
)
def d2(spark, sf):
    return distinct_dimensions(_old(spark, sf)).withColumnRenamed("key", "id")


@query(
    "d3_distinct_period_codes",
    "WITH " + inputs.with_inputs("old_batch") + "," + cells("old_batch")
    + "\nSELECT DISTINCT tabela_sidra_id, codigo FROM old_batch_cells WHERE codigo <> ''",
)
def d3(spark, sf):
    return distinct_period_codes(_old(spark, sf), by=("tabela_sidra_id",))


@query(
    "d4_insert_absent_places",
    "WITH " + inputs.with_inputs("old_batch", "meta_places") + "," + cells("old_batch")
    + "," + place_rows() + f"\nSELECT {PLACE_ID} AS id, nc, nn, d1c, d1n FROM places",
)
def d4(spark, sf):
    none = empty_star(spark).localidade
    described = insert_absent(none, places_from_metadata(inputs.metadata(spark, sf)), PLACE_KEY)
    places = insert_absent(described, distinct_places(_old(spark, sf)), PLACE_KEY)
    return places.selectExpr(f"{PLACE_KEY} AS id", "nc", "nn", "d1c", "d1n")


_PERIOD_OUT = "id, codigo, frequencia, ano, semestre, trimestre, mes"


@query(
    "d5_upsert_periods",
    "WITH " + inputs.with_inputs("meta_periods") + "," + PERIODS
    + """
SELECT id, codigo, frequencia, ano, semestre,
       CASE WHEN mes IS NOT NULL THEN CAST(ceil(mes / 3.0) AS INT) END AS trimestre, mes
FROM periods""",
)
def d5(spark, sf):
    periods = periods_from_metadata(inputs.metadata(spark, sf))
    stored = upsert_periods(empty_star(spark).periodo, periods.filter("frequencia <> 'anual'"))
    quarter = F.ceil(F.col("mes") / 3).cast("smallint")
    renewed = periods.filter("frequencia <> 'semestral'").withColumn("trimestre", quarter)
    merged = upsert_periods(stored, renewed)
    return merged.select(
        F.expr(PERIOD_KEY).alias("id"), "codigo", "frequencia", "ano",
        *(F.col(c).cast("int").alias(c) for c in ("semestre", "trimestre", "mes")),
    )


@query(
    "d6_upsert_catalogue",
    from_inputs(
        ("meta_cubes",),
        """SELECT id,
       CASE WHEN frequencia <> 'semestral' THEN concat('First ', nome) ELSE nome END AS nome,
       frequencia AS periodicidade,
       CASE WHEN frequencia <> 'semestral' THEN '2023-01-01' ELSE '2024-03-01' END
         AS ultima_atualizacao,
       nome AS described FROM meta_cubes""",
    ),
)
def d6(spark, sf):
    described = inputs.metadata(spark, sf)
    renamed = described.filter("periodicidade.frequencia <> 'semestral'").withColumn(
        "nome", F.concat(F.lit("First "), "nome")
    )
    empty = inputs.star(spark, sf).tabela_sidra.filter(F.lit(False))
    first = upsert_catalogue(empty, renamed, F.lit("2023-01-01").cast("date"))
    second = upsert_catalogue(first, described, F.lit("2024-03-01").cast("date"))
    return second.withColumn(
        "described", F.get_json_object("metadados", "$.nome")
    ).drop("metadados")


def _resolved(spark, sf, batch, keep_names=False):
    star = inputs.star(spark, sf)
    rows = null_sentinels(inputs.source(spark, sf, batch))
    return resolve_by_content(rows, star.periodo, star.tabela_sidra, keep_names=keep_names)


def _cells(spark, sf, batch):
    """The star with the members of a batch, and its accepted cells with ids."""
    star = inputs.star(spark, sf)
    rows = staged(_resolved(spark, sf, batch, keep_names=True), "resolved")
    places, dimensions, cells_ = insert_members(star, rows)
    grown = star._replace(
        localidade=star.localidade.unionByName(places), dimensao=star.dimensao.unionByName(dimensions)
    )
    return grown, cells_


_CELL = "tabela_sidra_id, localidade_id, dimensao_id, periodo_id"


@query(
    "d7_batch_cells",
    batch_inputs("new_batch")
    + f"""
SELECT {_CELL}, CAST(modificacao AS VARCHAR) AS modificacao, TRUE AS ativo, v FROM (
  SELECT *, row_number() OVER (PARTITION BY {_CELL}
    ORDER BY modificacao DESC, file_path, v) AS rn
  FROM new_batch_resolved WHERE reject_reason IS NULL) AS x
WHERE rn = 1""",
)
def d7_batch(spark, sf):
    star, cells_ = _cells(spark, sf, "new_batch")
    return with_content_keys(star, batch_cells(cells_, "keep_first"))


_NEW_CELLS = """
SELECT n.tabela_sidra_id, n.localidade_id, n.dimensao_id, n.periodo_id,
       CAST(n.modificacao AS VARCHAR) AS modificacao, TRUE AS ativo, n.v
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY {keys} ORDER BY modificacao DESC, file_path, v) AS rn
  FROM new_batch_resolved WHERE reject_reason IS NULL) AS n
LEFT JOIN facts f
  ON f.tabela_sidra_id = n.tabela_sidra_id AND f.localidade_id = n.localidade_id
 AND f.dimensao_id = n.dimensao_id AND f.periodo_id = n.periodo_id {more}
WHERE n.rn = 1 AND f.v IS NULL"""


@query(
    "d7_insert_absent_facts",
    batch_inputs("old_batch", "new_batch") + _NEW_CELLS.format(keys=_CELL, more=""),
)
def d7(spark, sf):
    star, cells_ = _cells(spark, sf, "new_batch")
    return with_content_keys(star, new_cells(star.dados, cells_, "keep_first"))


@query(
    "d7_insert_new_revisions",
    batch_inputs("old_batch", "new_batch")
    + _NEW_CELLS.format(
        keys=_CELL + ", modificacao", more="AND f.modificacao = n.modificacao"
    ),
)
def d7_latest(spark, sf):
    star, cells_ = _cells(spark, sf, "new_batch")
    return with_content_keys(star, new_cells(star.dados, cells_, "latest"))


@query(
    "d8_content_keys",
    "WITH " + inputs.with_inputs("old_batch", "meta_periods") + "," + PERIODS + ","
    + cells("old_batch")
    + f"""
SELECT 'dimensao' AS kind, id FROM (
  SELECT DISTINCT {DIM_ID} AS id FROM old_batch_cells WHERE d2c IS NOT NULL) AS d
UNION ALL SELECT 'localidade', id FROM (
  SELECT DISTINCT {PLACE_ID} AS id FROM old_batch_cells) AS l
UNION ALL SELECT 'periodo', id FROM periods""",
)
def d8(spark, sf):
    old = _old(spark, sf)

    def ids(kind, df):
        return df.select(F.lit(kind).alias("kind"), F.col("key").alias("id"))

    return (
        ids("dimensao", distinct_dimensions(old))
        .union(ids("localidade", distinct_places(old)))
        .union(ids("periodo", periods_from_metadata(inputs.metadata(spark, sf))))
    )


@query(
    "d9_unique_tables",
    from_inputs(
        ("meta_variables",),
        "SELECT DISTINCT tabela_sidra_id AS tabela_sidra FROM meta_variables",
    ),
)
def d9(spark, sf):
    requests = inputs.metadata(spark, sf).select(
        F.col("id").alias("tabela_sidra"), F.explode("variaveis.id").alias("variable")
    )
    return unique_tables(requests).select("tabela_sidra")


@query(
    "j6_unit_codes",
    "WITH " + inputs.with_inputs("old_batch", *_META) + "," + cells("old_batch") + ","
    + _MEMBERS
    + f""",
seen AS (
  SELECT tabela_sidra_id, MC AS mc, MN AS mn, coalesce(D2C, 'None') AS k2,
         coalesce(D4C, 'None') AS k4, coalesce(D5C, 'None') AS k5
  FROM old_batch_raw WHERE MC IS NOT NULL),
by_combo AS (SELECT tabela_sidra_id, k2, k4, k5, max(mc) AS mc FROM seen GROUP BY ALL),
by_name AS (SELECT tabela_sidra_id, mn, max(mc) AS mc FROM seen GROUP BY ALL)
SELECT m.tabela_sidra_id, coalesce(c.mc, n.mc) AS mc,
       {', '.join('m.' + c for c in DIMENSION_COLUMNS if c != 'mc')}
FROM members m
LEFT JOIN by_combo c ON c.tabela_sidra_id = m.tabela_sidra_id AND c.k2 = m.d2c
  AND c.k4 = coalesce(m.d4c, 'None') AND c.k5 = coalesce(m.d5c, 'None')
  AND m.d6c IS NULL
LEFT JOIN by_name n ON n.tabela_sidra_id = m.tabela_sidra_id AND n.mn = m.mn""",
)
def j6(spark, sf):
    members = dimension_members(inputs.metadata(spark, sf))
    return enrich_units(members, _old(spark, sf))

"""Queries on outputs and checks (T, U, A6, Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubestar.catalog import inputs
from cubestar.catalog.cells import _described_places, after
from cubestar.catalog.oracle import (
    DIM_ID,
    PERIODS,
    batch_inputs,
    cells,
    from_inputs,
    level,
    nulled,
    star_rows,
)
from cubestar.catalog.registry import query
from cubestar.catalog.scans import STAR_JOIN, VALUE, _run
from cubestar.functions.codes import dimension_key, null_sentinels, with_place_key
from cubestar.operators.dimensions import (
    complete_raw,
    with_values,
)
from cubestar.operators.outputs import (
    annual_summary,
    flatten,
    ordered,
    point_lookup,
    union_outputs,
)
from cubestar.operators.quality import (
    duplicate_keys,
    missing_values,
    orphan_facts,
    primary_key_violations,
    range_violations,
    star_duplicates,
    star_missing,
    unique_violations,
)
from cubestar.operators.surrogates import PLACE_KEY
from cubestar.plans.load import load_batch
from cubestar.plans.presets import (
    STANDARD_COLUMNS,
    SUMMARY_COLUMNS,
    crop_production,
    flat_output,
    municipal_gdp,
    point_series,
    price_index_history,
)
from cubestar.schema import Star

_FLAT = """SELECT codigo AS periodo, ano, mes, d1c AS localidade_id, d1n AS localidade,
       d2n AS variavel, d4n AS categoria, CAST(num AS VARCHAR) AS valor
FROM flat"""


@query("t3_flatten_star", f"{star_rows()}\n{_FLAT} WHERE tabela_sidra_id IN ('T1', 'T3')")
def t3(spark, sf):
    return flat_output(inputs.star(spark, sf), ["T1", "T3"])


@query(
    "t4_municipal_gdp",
    f"""{star_rows()}
SELECT ano, d1c AS id_municipio, d1n AS municipio, nc AS nivel_id, nn AS nivel,
       d2n AS variavel, mn AS unidade, d4n AS categoria, CAST(num AS VARCHAR) AS valor
FROM flat WHERE tabela_sidra_id = 'T3' ORDER BY ano, d1c""",
)
def t4(spark, sf):
    return municipal_gdp(inputs.star(spark, sf), ["T3"])


@query(
    "t5_price_index_history",
    f"""{star_rows()}
SELECT codigo AS periodo, ano, mes, nc AS nivel_territorial_id, nn AS nivel_territorial,
       d1c AS localidade_id, d1n AS localidade, d2n AS variavel, d4n AS categoria,
       CAST(num AS VARCHAR) AS valor
FROM flat WHERE tabela_sidra_id IN ('T1', 'T3')
ORDER BY ano, mes, d1c, d2n, d4n""",
)
def t5(spark, sf):
    return price_index_history(inputs.star(spark, sf), ["T1", "T3"])


@query(
    "t6_crop_production",
    f"""{star_rows()}
SELECT ano, d1c AS id_municipio, d1n AS municipio, d4n AS produto, d2n AS variavel,
       mn AS unidade, CAST(num AS VARCHAR) AS valor
FROM flat WHERE tabela_sidra_id = 'T3'""",
)
def t6(spark, sf):
    return crop_production(inputs.star(spark, sf), ["T3"])


@query(
    "t7_point_series",
    f"""{star_rows()}
SELECT ano, mes, d1n AS localidade, d2n AS variavel, d4n AS categoria,
       CAST(TRY_CAST(v AS DECIMAL(38,10)) AS VARCHAR) AS valor
FROM flat WHERE tabela_sidra_id = 'T1' AND d1c = '7' ORDER BY ano, mes""",
)
def t7(spark, sf):
    return point_series(inputs.star(spark, sf), "T1", "7", strict=False)


@query(
    "t8_analytic_lookup",
    f"""{star_rows()}
SELECT tabela_sidra_id AS tabela, codigo AS periodo, ano, mes, nc AS nivel,
       d1c AS localidade_id, d1n AS localidade, d2n AS variavel, mn AS unidade,
       d4n AS categoria, CAST(num AS VARCHAR) AS valor
FROM flat WHERE d1c = '7'
  AND nc = (SELECT max(nc) FROM flat WHERE tabela_sidra_id = 'T3') ORDER BY codigo DESC""",
)
def t8(spark, sf):
    """The customer 7 and not the nation 7."""
    flat = flatten(inputs.star(spark, sf), None, SUMMARY_COLUMNS)
    level = flat.filter("tabela = 'T3'").agg(F.max("nivel")).first()[0]
    return point_lookup(flat, "7", level=level)


@query(
    "t9_rollup_of_outputs",
    f"""{star_rows()}
SELECT codigo AS periodo, ano, mes, d1c AS localidade_id, d1n AS localidade,
       d2n AS variavel, d4n AS categoria, CAST(num AS VARCHAR) AS valor,
       CASE tabela_sidra_id WHEN 'T1' THEN 'nations' WHEN 'T2' THEN 'balances'
            ELSE 'customers' END AS source
FROM flat""",
)
def t9(spark, sf):
    star = inputs.star(spark, sf)
    return union_outputs(
        {
            "nations": flat_output(star, ["T1"]),
            "balances": flat_output(star, ["T2"]),
            "customers": flat_output(star, ["T3"]),
        }
    )


@query(
    "u4_child_order",
    f"""{star_rows()}
SELECT CASE tabela_sidra_id WHEN 'T2' THEN 1 WHEN 'T3' THEN 2 ELSE 3 END AS ordinal,
       CASE tabela_sidra_id WHEN 'T1' THEN 'nations' WHEN 'T2' THEN 'balances' ELSE 'customers' END AS source,
       count(*) AS n
FROM flat GROUP BY tabela_sidra_id""",
)
def u4(spark, sf):
    """Children are taken by name, not in the order they are given in."""
    star = inputs.star(spark, sf)
    given = {name: flat_output(star, [cube]) for name, cube in (("nations", "T1"), ("customers", "T3"), ("balances", "T2"))}
    return union_outputs(given, ordinal=True).groupBy("ordinal", "source").agg(F.count(F.lit(1)).alias("n"))


_SUMMARY = """
SELECT tabela_sidra_id AS tabela, ano, nc AS nivel, d1c AS localidade_id, d2n AS variavel,
       mn AS unidade, d4n AS categoria, count(num) AS n,
       CAST(CAST(sum(num) AS DECIMAL(38,10)) AS VARCHAR) AS soma,
       CASE WHEN count(num) > 0
            THEN CAST(sum(num) AS DOUBLE) / count(num) END AS media,
       CAST(min(num) AS VARCHAR) AS minimo, CAST(max(num) AS VARCHAR) AS maximo
FROM flat GROUP BY tabela_sidra_id, ano, nc, d1c, d2n, mn, d4n"""


@query("a6_annual_summary", star_rows() + _SUMMARY)
def a6(spark, sf):
    """All cubes: nations and customers have equal place codes on other levels."""
    return annual_summary(flatten(inputs.star(spark, sf), None, SUMMARY_COLUMNS))


@query(
    "u1_ordered_output",
    f"{star_rows()}\n{_FLAT} ORDER BY codigo, d1c",
)
def u1(spark, sf):
    flat = flatten(inputs.star(spark, sf), None, STANDARD_COLUMNS)
    return ordered(flat, "periodo", "localidade_id")


@query(
    "u2_union_rollup",
    f"""{star_rows()}
SELECT ano, d1c AS localidade_id, CAST(num AS VARCHAR) AS valor,
       CASE tabela_sidra_id WHEN 'T2' THEN 'balances' ELSE 'customers' END AS source
FROM flat WHERE tabela_sidra_id IN ('T2', 'T3')""",
)
def u2(spark, sf):
    star = inputs.star(spark, sf)
    columns = {"ano": "p.ano", "localidade_id": "l.d1c"}
    return union_outputs(
        {
            "customers": flatten(star, ["T3"], columns),
            "balances": flatten(star, ["T2"], columns),
        }
    )


@query(
    "u3_stitched_series",
    f"""{star_rows()}
SELECT tabela_sidra_id AS cube, ano, mes, d2n AS variavel, count(*) AS n,
       count(num) AS n_numbers
FROM flat WHERE tabela_sidra_id IN ('T1', 'T2', 'T3') GROUP BY ALL""",
)
def u3(spark, sf):
    columns = {**STANDARD_COLUMNS, "cube": "d.tabela_sidra_id"}
    history = flatten(inputs.star(spark, sf), ["T1", "T2", "T3"], columns)
    return history.groupBy("cube", "ano", "mes", "variavel").agg(
        F.count(F.lit(1)).alias("n"), F.count("valor").alias("n_numbers")
    )


_FLAT_SQL = f"""
SELECT p.ano, l.d1c AS localidade_id, dim.d2n AS variavel, dim.d4n AS categoria,
       dim.d5n AS situacao, p.codigo AS periodo, d.tabela_sidra_id AS cubo, {VALUE}
{STAR_JOIN} WHERE d.tabela_sidra_id IN ('T1', 'T3') AND d.ativo"""


@query(
    "t1_materialized_outputs",
    f"""{star_rows()}
SELECT ano, d1c AS localidade_id, d2n AS variavel, d4n AS categoria, count(num) AS n,
       CAST(CAST(sum(num) AS DECIMAL(38,10)) AS VARCHAR) AS soma
FROM flat WHERE tabela_sidra_id IN ('T1', 'T3') GROUP BY ano, d1c, d2n, d4n""",
)
def t1(spark, sf):
    """A checked table, then a view that reads it by its qualified name."""
    schema = _run(
        spark, sf,
        {
            "name": "lines", "strategy": "replace", "sql": _FLAT_SQL,
            "primary_key": [
                "cubo", "periodo", "localidade_id", "variavel", "categoria", "situacao",
            ],
            "indexes": [{"name": "ix_ano", "columns": ["ano"]}],
            "description": "Lines by place and category",
        },
        {
            "name": "lines_by_year", "strategy": "view",
            "sql": "SELECT ano, localidade_id, variavel, categoria, count(valor) AS n,"
            " CAST(sum(valor) AS DECIMAL(38,10)) AS soma FROM {analytics}.lines"
            " GROUP BY ano, localidade_id, variavel, categoria",
        },
    )
    return spark.table(f"{schema}.lines_by_year")


@query(
    "t2_name_resolution",
    f"""{star_rows()}
SELECT tabela_sidra_id, count(*) AS n, count(DISTINCT d1c) AS n_places
FROM flat GROUP BY tabela_sidra_id""",
)
def t2(spark, sf):
    """Unqualified names are star tables, qualified names earlier outputs."""
    schema = _run(
        spark, sf,
        {
            "name": "places", "strategy": "replace",
            "sql": "SELECT id, d1c FROM localidade",
            "indexes": [{"name": "ux", "columns": ["id"], "unique": True}],
        },
        {
            "name": "counts", "strategy": "replace",
            "sql": "SELECT d.tabela_sidra_id, count(*) AS n,"
            " count(DISTINCT l.d1c) AS n_places FROM dados d"
            " JOIN {analytics}.places l ON d.localidade_id = l.id"
            " WHERE d.ativo GROUP BY d.tabela_sidra_id",
        },
    )
    return spark.table(f"{schema}.counts")


# --- checks ---------------------------------------------------------------


@query(
    "q1_primary_key",
    f"""{star_rows()}
SELECT periodo, localidade_id, categoria, n_rows,
       CASE WHEN categoria IS NULL THEN 'null' ELSE 'duplicate' END AS violation
FROM (SELECT codigo AS periodo, d1c AS localidade_id, d4n AS categoria,
             count(*) AS n_rows
      FROM flat GROUP BY codigo, d1c, d4n) AS g
WHERE categoria IS NULL OR n_rows > 1""",
)
def q1(spark, sf):
    flat = flatten(inputs.star(spark, sf), None, STANDARD_COLUMNS)
    return primary_key_violations(flat, ["periodo", "localidade_id", "categoria"])


@query(
    "q2_unique_index",
    f"""{star_rows()}
SELECT codigo AS periodo, d1c AS localidade_id, d4n AS categoria, count(*) AS n_rows
FROM flat WHERE d4n IS NOT NULL GROUP BY codigo, d1c, d4n HAVING count(*) > 1""",
)
def q2(spark, sf):
    flat = flatten(inputs.star(spark, sf), None, STANDARD_COLUMNS)
    return unique_violations(flat, ["periodo", "localidade_id", "categoria"])


@query(
    "q3_clustered_output",
    f"{star_rows()}\n{_FLAT} WHERE tabela_sidra_id = 'T3'",
)
def q3(spark, sf):
    schema = _run(
        spark, sf,
        {
            "name": "clustered", "strategy": "replace",
            "sql": "SELECT p.codigo AS periodo, p.ano, p.mes, l.d1c AS localidade_id,"
            f" l.d1n AS localidade, dim.d2n AS variavel, dim.d4n AS categoria, {VALUE}"
            f" {STAR_JOIN} WHERE d.tabela_sidra_id = 'T3' AND d.ativo",
            "indexes": [{"name": "ix", "columns": ["localidade_id", "periodo"]}],
        },
    )
    return spark.table(f"{schema}.clustered")


@query(
    "q4_orphan_facts",
    batch_inputs("old_batch").replace(
        "WITH ", "WITH " + inputs.with_inputs("meta_places") + ",", 1
    )
    + f""",
known AS (
  SELECT DISTINCT md5(concat('v', length({level('nivel')}), ':', {level('nivel')},
                             'v', length(id), ':', id)) AS id FROM meta_places)
SELECT 'localidade_id' AS foreign_key, f.localidade_id AS id, count(*) AS n_facts
FROM facts f LEFT JOIN known k ON k.id = f.localidade_id
WHERE k.id IS NULL GROUP BY f.localidade_id""",
)
def q4(spark, sf):
    star = inputs.star(spark, sf)
    orphans = orphan_facts(star._replace(localidade=_described_places(spark, sf, star)))
    keys = star.localidade.selectExpr("CAST(id AS STRING) AS id", f"{PLACE_KEY} AS key")
    return orphans.join(keys, "id", "left").select("foreign_key", F.col("key").alias("id"), "n_facts")


@query(
    "q5_ranges",
    """SELECT o_orderkey, semestre, trimestre, mes,
       concat_ws(',', CASE WHEN semestre NOT BETWEEN 1 AND 2 THEN 'semestre' END,
                 CASE WHEN trimestre NOT BETWEEN 1 AND 4 THEN 'trimestre' END,
                 CASE WHEN mes NOT BETWEEN 1 AND 12 THEN 'mes' END) AS outside
FROM (SELECT o_orderkey, CAST(ceil(month(o_orderdate) / 4.0) AS INT) AS semestre,
             CAST(ceil(month(o_orderdate) / 2.0) AS INT) AS trimestre,
             CASE WHEN day(o_orderdate) < 20 THEN CAST(day(o_orderdate) AS INT) END AS mes
      FROM orders) AS p
WHERE semestre > 2 OR trimestre > 4 OR mes > 12""",
)
def q5(spark, sf):
    """Order dates read with the wrong month lengths give periods out of range."""
    date = F.col("o_orderdate")
    day = F.day(date)
    periods = inputs.table(spark, sf, "orders").select(
        "o_orderkey",
        F.ceil(F.month(date) / 4).cast("int").alias("semestre"),
        F.ceil(F.month(date) / 2).cast("int").alias("trimestre"),
        F.when(day < 20, day).alias("mes"),
    )
    return range_violations(periods)


@query(
    "q6_duplicate_keys",
    f"""WITH {inputs.with_inputs('old_batch', 'new_batch', 'meta_cubes', 'meta_periods')},
{PERIODS},{cells('old_batch')},{cells('new_batch')}
SELECT tabela_sidra_id, nc, d1c, d2c, d4c, d5c, codigo, count(*) AS n_rows
FROM new_batch_cells GROUP BY ALL HAVING count(*) > 1""",
)
def q6(spark, sf):
    """Cells a batch sends more than once, by the key of the facts."""
    rows = with_values(
        complete_raw(null_sentinels(inputs.source(spark, sf, "new_batch")))
    ).selectExpr(
        "tabela_sidra_id", "NC", "D1C", *dimension_key(), "D3C AS codigo"
    )
    return duplicate_keys(
        with_place_key(rows),
        ["tabela_sidra_id", "nc", "d1c", "d2c", "d4c", "d5c", "codigo"],
    )


#: Rows of each star table that the checks below break.
_PLANTED = {
    "tabela_sidra": "id LIKE 'S%'", "localidade": "nc = 'N3'", "periodo": "frequencia = 'anual'",
    "dimensao": "mc = '30'", "dados": "tabela_sidra_id = 'T2'",
}
_PLANTED_ORACLE = f"""
SELECT 'tabela_sidra' AS table_name, CAST(count(*) AS INT) AS n FROM meta_cubes WHERE id LIKE 'S%'
UNION ALL SELECT 'localidade', CAST(count(*) AS INT) FROM (
  SELECT DISTINCT id FROM meta_places WHERE {level('nivel')} = 'N3') AS l
UNION ALL SELECT 'periodo', CAST(count(*) AS INT) FROM periods WHERE frequencia = 'anual'
UNION ALL SELECT 'dimensao', CAST(count(DISTINCT {DIM_ID}) AS INT) FROM old_batch_cells
  WHERE mc = '30' AND d2c IS NOT NULL"""


@query(
    "q6_star_duplicates",
    batch_inputs("old_batch", "new_batch").replace("WITH ", "WITH " + inputs.with_inputs("meta_places") + ",", 1)
    + "," + after("latest") + _PLANTED_ORACLE
    + """
UNION ALL SELECT 'dados', CAST(count(*) AS INT) FROM after WHERE tabela_sidra_id = 'T2'""",
)
def q6_star(spark, sf):
    """Some rows of every table occur twice: these and no others are found."""
    star = load_batch(inputs.star(spark, sf), inputs.source(spark, sf, "new_batch")).star
    broken = Star(*(df.unionByName(df.filter(_PLANTED[name])) for name, df in star._asdict().items()))
    return _counts(star_duplicates(broken))


def _counts(found):
    parts = [
        df.groupBy(F.lit(name).alias("table_name")).agg(
            F.count(F.lit(1)).cast("int").alias("n")
        )
        for name, df in found.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "q7_required_columns",
    from_inputs(
        ("cells",),
        f"""SELECT tabela_sidra_id, D1C, D3C, D2C, D4C, V,
       concat_ws(',', CASE WHEN D2C IS NULL THEN 'D2C' END,
                 CASE WHEN D4C IS NULL THEN 'D4C' END,
                 CASE WHEN V IS NULL THEN 'V' END) AS missing
FROM (SELECT tabela_sidra_id, D1C, D3C, {nulled('D2C')} AS D2C, D4C,
             {nulled('V')} AS V FROM cells) AS c
WHERE D2C IS NULL OR D4C IS NULL OR V IS NULL""",
    ),
)
def q7(spark, sf):
    rows = null_sentinels(inputs.source(spark, sf, "cells")).select(
        "tabela_sidra_id", "D1C", "D3C", "D2C", "D4C", "V"
    )
    return missing_values(rows, ["D2C", "D4C", "V"])


#: A required column of each table, emptied where the rows are planted.
_EMPTIED = {"tabela_sidra": "nome", "localidade": "nn", "periodo": "codigo", "dimensao": "d2n", "dados": "v"}


@query(
    "q7_star_required",
    batch_inputs("old_batch").replace("WITH ", "WITH " + inputs.with_inputs("meta_places") + ",", 1)
    + _PLANTED_ORACLE
    + """
UNION ALL SELECT 'dados', CAST(count(*) AS INT) FROM facts WHERE tabela_sidra_id = 'T2'""",
)
def q7_star(spark, sf):
    """Required columns are emptied in some rows of every table."""
    star: Star = inputs.star(spark, sf)
    broken = Star(
        *(
            df.withColumn(_EMPTIED[name], F.expr(f"CASE WHEN NOT coalesce({_PLANTED[name]}, false) THEN {_EMPTIED[name]} END"))
            for name, df in star._asdict().items()
        )
    )
    return _counts(star_missing(broken))
